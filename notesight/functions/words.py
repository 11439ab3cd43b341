"""Word lists, phrases and patterns the cleaning rules are defined by."""

# English stop words of the Natural Language Toolkit.
STOP_WORDS = (
    "i me my myself we our ours ourselves you you're you've you'll you'd your yours yourself yourselves "
    "he him his himself she she's her hers herself it it's its itself they them their theirs themselves "
    "what which who whom this that that'll these those am is are was were be been being have has had "
    "having do does did doing a an the and but if or because as until while of at by for with about "
    "against between into through during before after above below to from up down in out on off over "
    "under again further then once here there when where why how all any both each few more most other "
    "some such no nor not only own same so than too very s t can will just don don't should should've "
    "now d ll m o re ve y ain aren aren't couldn couldn't didn didn't doesn doesn't hadn hadn't hasn "
    "hasn't haven haven't isn isn't ma mightn mightn't mustn mustn't needn needn't shan shan't shouldn "
    "shouldn't wasn wasn't weren weren't won won't wouldn wouldn't"
).split()

# English stop words of Spark's StopWordsRemover; a test holds them equal to the built-in list.
REMOVER_STOP_WORDS = (
    "i me my myself we our ours ourselves you your yours yourself yourselves he him his himself she her "
    "hers herself it its itself they them their theirs themselves what which who whom this that these "
    "those am is are was were be been being have has had having do does did doing a an the and but if or "
    "because as until while of at by for with about against between into through during before after "
    "above below to from up down in out on off over under again further then once here there when where "
    "why how all any both each few more most other some such no nor not only own same so than too very s "
    "t can will just don should now i'll you'll he'll she'll we'll they'll i'd you'd he'd she'd we'd "
    "they'd i'm you're he's she's it's we're they're i've we've you've they've isn't aren't wasn't "
    "weren't haven't hasn't hadn't don't doesn't didn't won't wouldn't shan't shouldn't mustn't can't "
    "couldn't cannot could here's how's let's ought that's there's what's when's where's who's why's would"
).split()

# Words dropped as carrying no information in a discharge summary.
CUSTOM_WORDS = (
    "admission date discharge birth sex service medicine allergies g/dl k/ul mg/dl meq/l mmol/l iu/l"
).split()

# How often a drug is taken, as patterns; tried in this order.
FREQUENCY_PHRASES = (
    r"by mouth", r"q\sd", r"on odd days", r"times a day", r"times per day", r"at dinner",
    r"at breakfast", r"at bedtime", r"q\. day", r"q d\.", r"q a\.m\.", r"q p\.m\.", r"q am",
    r"q pm", r"q day", r"q\.day", r"q\.hs", r"meq", r"q\.d\.", r"b\.i\.d\.", r"t\.i\.d\.",
    r"q\.i\.d", r"q\dh", r"p\.r\.n\.", r"p\.o\.",
)
FREQUENCY_WORDS = ("daily", "sig", "day", "times", "tablet")

# Dose units; the second cleaner knows all but "po", with "mgs" tried before "mg".
DOSE_UNITS = (
    "micrograms", "microgram", "mgs", "mg", "ml", "milligrams", "milligram", "milliequivalents",
)

NUMBER_WORDS = (
    "zero", "one", "two", "three", "four", "five", "six", "seven", "eight", "nine", "ten", "eleven",
    "twelve", "thirteen", "fourteen", "fifteen", "sixteen", "seventeen", "eighteen",
)

# Form fields of the second cleaner.
FORM_WORDS = (r"sex:\s*f", r"sex:\s*m", r"service", r"completed by")
DATE_HEADINGS = (
    "admission date", "date of admission", "discharge date", "date of discharge", "date of birth",
)
CLOCK_TIMES = (
    r"[0-1]?[0-9] ?[aApP][mM]",
    r"(?:0?[1-9]|1[0-2])[:.][0-5][0-9] ?[aApP][mM]",
    r"(?:0?[0-9]|1[0-9]|2[0-3])[:.][0-5][0-9]",
)
LAB_UNITS = ("g/dl", "k/ul", "mg/dl", "meq/l", "mmol/l", "iu/l")

# Section name -> header pattern, on lower-cased text.
SECTION_HEADERS = {
    "discharge_condition": r"(?:discharge condition.*?:|condition at discharge.*?:)",
    "discharge_disposition": r"(?:discharge disposition.*?:|discharge status.*?:)",
    "discharge_diagnosis": r"discharge diagnos.*?:",
    "discharge_medication": r"discharge medicat.*?:",
    "discharge_instructions": r"discharge instruction.*?:",
}
