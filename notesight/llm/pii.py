"""Personal data in whole texts, also where it is disguised, with spans in the source's code points.

The base kinds are found on the text itself. Then transducers rewrite look-alike letters, spelled digits and
at/dot disguises; each keeps, for every character it emits, the source characters that character stands for, so that
what is found in the rewritten text maps back. A found span is added if it holds a rewritten character and
overlaps no base span of its kind.

Null or empty texts have no spans. Each row stands for itself, so ties and repeats need no rule. Time is
linear in the length of a text. Columns named spans or text_redacted are replaced."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
from pyspark.sql import DataFrame

from notesight.llm.common import by_batch, reads

KINDS = ("email", "ip", "card", "phone")
SPANS = "array<struct<kind:string,start:int,end:int,disguised:boolean>>"

Span = tuple[int, int]
Edit = tuple[int, int, str]

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")  # no match can begin inside a run of digits
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def emails(text: str) -> Iterator[Span]:
    """Leftmost matches of local@domain, found from their @ so that long runs without one cost nothing."""
    done = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        found = DOMAIN.match(text, at + 1) if start < at else None
        if found:
            done = found.end()
            yield start, done
        at = text.find("@", max(at + 1, done))


def ips(text: str) -> Iterator[Span]:
    for found in IP.finditer(text):
        if all(len(part) <= 3 and int(part) <= 255 for part in (p.lstrip("0") or "0" for p in found[0].split("."))):
            yield found.span()


def cards(text: str) -> Iterator[Span]:
    for found in CARD.finditer(text):
        if found.end() - found.start() < 16:
            continue
        digits = [int(c) for c in found[0] if c.isdigit()]
        if 16 <= len(digits) <= 19 and luhn(digits):
            yield found.span()


def luhn(digits: list[int]) -> bool:
    doubled = [d * 2 - 9 * (d > 4) for d in digits[-2::-2]]
    return (sum(digits[-1::-2]) + sum(doubled)) % 10 == 0


def phones(text: str) -> Iterator[Span]:
    for found in PHONE.finditer(text):
        if 8 <= sum(map(str.isdigit, found[0])) <= 15:
            yield found.span()


FINDERS: dict[str, Callable[[str], Iterator[Span]]] = {"email": emails, "ip": ips, "card": cards, "phone": phones}

# Letters that look like ASCII ones, by script, and marks without a width.
CYRILLIC = dict(zip("авеікмнорстухјѕѵԁԛԝАВЕІКМНОРСТУХЈЅ", "abeikmhopctyxjsvdqwABEIKMHOPCTYXJS"))
GREEK = dict(zip("αικνορυχΑΒΕΖΗΙΚΜΝΟΡΤΥΧ", "aiknopuxABEZHIKMNOPTYX"))
WIDTHLESS = "".join(map(chr, (0xAD, 0x200B, 0x200C, 0x200D, 0x2060, 0xFEFF)))
SIGNS = dict(zip("‐‑‒–․。｡﹫", "----...@"))
# Words for digits, and endings of host names that make a bare "at ... . ..." an address; after the word dot any ending does.
DIGITS = "zero one two three four five six seven eight nine".split()
ENDINGS = "com org net edu gov info biz io co de fr es uk us it nl ru eu example test".split()

LOOKALIKE = {
    **{ord(a): b for a, b in (CYRILLIC | GREEK | SIGNS).items()},
    **{ord(c): "" for c in WIDTHLESS},
    **{c: chr(c - 0xFEE0) for c in range(0xFF01, 0xFF5F)},  # full-width forms
}
LOOKALIKES = re.compile("[" + "".join(map(re.escape, map(chr, LOOKALIKE))) + "]")
_NUMBER = "|".join(DIGITS)
_STEP = rf"(?:{_NUMBER}|dot|point|[0-9]{{1,4}})"
SPELLED = re.compile(rf"(?i)(?<![a-z0-9])(?:plus[ -]+)?(?:{_NUMBER})(?:[ ,-]{{1,2}}{_STEP}){{6,}}(?![a-z0-9])")
SPELLED_PART = re.compile(rf"(?i)plus[ -]+|{_NUMBER}|dot|point|[0-9]+|[ ,-]+")
_TLD = "(?:" + "|".join(ENDINGS) + r")(?![A-Za-z0-9])"
BRACKETED = re.compile(r"(?i)[\[({<]\s{0,3}(?:(?P<at>at|@)|dot|\.)\s{0,3}[\])}>]\s{0,3}(?=[a-z0-9])")
CODED = re.compile(r"(?i)(?P<at>&#0{0,3}64;|&#x0{0,3}40;|&commat;)|&#0{0,3}46;|&#x0{0,3}2e;|&period;")
_ARTICLE = "the|a|an|this|that|these|those|my|your|our|his|her|their|any|each|every|some|no"  # fixed values: not a host
BARE = re.compile(
    rf"(?i)(?<=[a-z0-9])(?P<at> {{1,2}}(?:at|@) {{1,2}})(?!(?:{_ARTICLE}) )(?=(?:[a-z0-9-]{{1,63}} {{1,2}}(?:dot|\.) {{1,2}}){{0,3}}[a-z0-9-]{{1,63}}"
    rf" {{1,2}}(?:dot {{1,2}}[a-z]{{2,24}}(?![a-z0-9])|\. {{1,2}}{_TLD}))"
)
#: Names joined by the word dot before an "at".
LOCAL_DOTS = re.compile(r"(?i)(?<![a-z0-9._%+-])(?:[a-z0-9_%+-]{1,64} {1,2}dot {1,2}){1,4}[a-z0-9_%+-]{1,64}\Z")
DOT_WORD = re.compile(r"(?i) {1,2}dot {1,2}")
BARE_DOT = re.compile(rf"(?i)(?<=[a-z0-9-])( {{1,2}}(?:dot|\.) {{1,2}})(?=[a-z0-9])")


def lookalikes(text: str) -> Iterator[Edit]:
    if not text.isascii():
        for found in LOOKALIKES.finditer(text):
            yield found.start(), found.end(), LOOKALIKE[ord(found[0])]


def spelled_digits(text: str) -> Iterator[Edit]:
    for run in SPELLED.finditer(text):
        for part in SPELLED_PART.finditer(text, run.start(), run.end()):
            word = part[0].lower()
            if word in DIGITS:
                yield *part.span(), str(DIGITS.index(word))
            elif word in ("dot", "point"):
                yield *part.span(), "."
            elif word.startswith("plus"):
                yield *part.span(), "+"
            elif not word.isdigit():
                yield *part.span(), ""


def at_and_dot(text: str) -> Iterator[Edit]:
    """[at], (dot) and the like between characters of a name, with up to three blanks around; character codes."""
    found_in = [(m.start(), m.end(), "@" if m["at"] else ".", True) for m in BRACKETED.finditer(text)]
    if "&" in text:
        found_in += [(m.start(), m.end(), "@" if m["at"] else ".", False) for m in CODED.finditer(text)]
    done = 0
    for start, end, sign, bracket in sorted(found_in):
        if bracket:
            low = max(done, start - 3)
            while start > low and text[start - 1].isspace():
                start -= 1
            if not start or text[start - 1] not in LOCAL or (sign == "." and text[start - 1] in "._%+-"):
                continue
        yield start, end, sign
        done = end


def bare_at_and_dot(text: str) -> Iterator[Edit]:
    done = 0
    for found in BARE.finditer(text) if " dot " in text.lower() or " . " in text else ():
        if found.start() < done:
            continue
        low = max(done, found.start() - 360)
        if names := LOCAL_DOTS.search(text[low : found.start()]):
            for dot in DOT_WORD.finditer(text, low + names.start(), low + names.end()):
                yield *dot.span(), "."
        yield *found.span("at"), "@"
        at = found.end()
        while dot := BARE_DOT.search(text, at, at + 68):  # a label and the dot after it
            if " " in text[at : dot.start()]:
                break
            yield *dot.span(), "."
            at = done = dot.end()


TRANSDUCERS = (lookalikes, spelled_digits, at_and_dot, bare_at_and_dot)


class Rewritten:
    """A text with, for each character, the source span it stands for and whether it was rewritten."""

    def __init__(self, text: str):
        self.text = text
        self.starts = np.arange(len(text))
        self.ends = self.starts + 1
        self.changed = np.zeros(len(text), bool)

    def apply(self, edits: list[Edit]) -> None:
        texts, starts, ends, changed, at = [], [], [], [], 0
        for start, end, new in edits:
            texts += [self.text[at:start], new]
            starts += [self.starts[at:start], np.full(len(new), self.starts[start])]
            ends += [self.ends[at:start], np.full(len(new), self.ends[end - 1])]
            changed += [self.changed[at:start], np.ones(len(new), bool)]
            if not new and changed[-2].size:
                changed[-2] = changed[-2].copy()
                changed[-2][-1] = True  # what stands before a dropped character is no longer as it was
            at = end
        self.text = "".join([*texts, self.text[at:]])
        self.starts = np.concatenate([*starts, self.starts[at:]])
        self.ends = np.concatenate([*ends, self.ends[at:]])
        self.changed = np.concatenate([*changed, self.changed[at:]])


def rewrite(text: str) -> Rewritten | None:
    """The text after all transducers, or None if none has anything to do."""
    out: Rewritten | None = None
    for transducer in TRANSDUCERS:
        edits = list(transducer(out.text if out else text))
        if edits:
            out = out or Rewritten(text)
            out.apply(edits)
    return out


def find(text: str | None) -> list[tuple[str, int, int, bool]]:
    """(kind, start, end, disguised) of a text, by kind as in KINDS, then by start."""
    if not text:
        return []
    spans = {kind: [(s, e, False) for s, e in FINDERS[kind](text)] for kind in KINDS}
    plain = rewrite(text)
    if plain:
        for kind in KINDS:
            base = list(spans[kind])
            for start, end in FINDERS[kind](plain.text):
                if plain.changed[start:end].any():
                    s, e = int(plain.starts[start]), int(plain.ends[end - 1])
                    if not any(s < be and bs < e for bs, be, _ in base):
                        spans[kind].append((s, e, True))
    return [(kind, *span) for kind in KINDS for span in sorted(spans[kind])]


def detect(docs: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Add `spans` to the columns `keep` (default: all). One pass over whole texts, no shuffle."""
    keep = [c for c in (docs.columns if keep is None else keep) if c != "spans"]

    @reads(text)
    def make(batch: dict[str, list]) -> dict[str, list]:
        names = ("kind", "start", "end", "disguised")
        return {"spans": [[dict(zip(names, span)) for span in find(t)] for t in batch[text]]}

    return by_batch(docs.select(*dict.fromkeys([*keep, text])), keep, f"spans {SPANS}", make)


def redact(docs: DataFrame, text: str = "text") -> DataFrame:
    """The same rows and columns with [EMAIL], [IP], [CARD] or [PHONE] in place of what was found; spans that
    overlap become one mark, of the first kind."""

    def redacted(value: str | None) -> str | None:
        parts, at = [], 0
        for kind, start, end, _ in sorted(find(value), key=lambda s: (s[1], -s[2])):
            if start >= at:
                parts += [value[at:start], f"[{kind.upper()}]"]
            at = max(at, end)
        return "".join([*parts, value[at:]]) if parts else value

    keep = [c for c in docs.columns if c != text]
    made = by_batch(docs, keep, f"`{text}` string", lambda batch: {text: list(map(redacted, batch[text]))})
    return made.select(*docs.columns)
