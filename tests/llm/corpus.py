"""A small table of odd documents, and brute-force helpers."""

import random
import re

ASCII_WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, kept string, hits int, node string, spans string, "
          "rank int, split string, n_words string, arc double, `odd name, 1` map<string,int>")


def prose(n: int, seed: int, letters: str = "abcdefghijklmnopqrstuvwxyz") -> str:
    """`n` invented words in lines of a dozen."""
    rng = random.Random(seed)
    words = ["".join(rng.choices(letters, k=rng.randint(2, 9))) for _ in range(n)]
    return ".\n".join(" ".join(words[i : i + 12]) for i in range(0, n, 12)) + "."


def odd_texts() -> list[tuple[int | None, str | None]]:
    base = prose(200, 1)
    near = base.replace(base.split()[50], "changed")
    return [
        (1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, "one"), (6, base), (7, base), (8, near), (8, near), (None, base), (None, None),
        (9, prose(3000, 2)), (10, "a" * 30_000), (11, prose(80, 3) + "  x y 　 " + prose(40, 4)), (12, "@" * 500 + "1." * 500 + "+" * 500),
        (13, "é ß \U0001f600 <|endoftext|> \x00 'll\r\n" + prose(60, 5)), (14, prose(120, 6)), (15, prose(30, 7) + base), (16, prose(150, 8)),
    ]


def odd(spark):
    """The odd documents with further columns, some of which have names that operators use."""
    rows = [(i, t, None, "s", None if t is None else len(t), "k", 1, None, "x", 2, "s", "w", 0.5, {"a": 1}) for i, t in odd_texts()]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def roots(links, nodes):
    """Smallest node that each reaches."""
    up = {n: n for n in nodes}

    def find(x):
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}
