"""Word lists, rule tables and numbers that decide results.

Everything here is data. Changing an entry changes what the operators report.
"""

from __future__ import annotations

from itertools import product

MIN_EMPLOYEES = 20
ALPHA = 0.05
FOREST_TREES = 100
HISTOGRAM_BINS = 200
COSINE_THRESHOLD = 0.85
PROFILE_LABEL_THRESHOLD = 0.6
COMPANY_LABEL_THRESHOLD = 0.3
DOMINANT_VECTORS = 2
SECTION_LIMITS = {"values": 3, "patterns": 3, "picture": 1, "theme": 1}

# The twenty universities that set the top-university flag.
TOP_UNIVERSITIES = [
    "princeton", "stanford", "massachusetts institute of technology", "yale", "berkeley",
    "columbia", "university of pennsylvania", "harvard", "rice", "cornell", "northwestern",
    "johns hopkins", "university of california", "university of chicago", "vanderbilt",
    "dartmouth", "williams", "brown", "claremont mckenna", "duke",
]

# Spellings that name a degree level. The first level with a hit wins.
DEGREE_SPELLINGS = {
    "Bachelor": ["bachelor", "bsc", "b.a.", "b.a", "b.s.", "b.s", "bachelor of science", "licence"],
    "Master": ["master", "msc", "m.s.", "m.s", "m.a.", "m.a", "master of science", "master of arts"],
    "Doctorate": ["phd", "ph.d", "doctorate", "doctoral", "dr.", "doctor"],
    "Associate": ["associate", "a.a.", "a.a", "a.s.", "a.s", "assoc."],
}
DEGREES = sorted(DEGREE_SPELLINGS)

# Number of each degree as a forest feature; no degree is 0.
DEGREE_CODES = {"Bachelor": 1, "Master": 2, "Doctorate": 3, "Associate": 4}

# What volunteering as such, and each cause, says about a person.
VOLUNTEER_VALUES = ["Community", "Contribution", "Meaningful work"]
CAUSE_VALUES = {
    "Education": "Altruism",
    "Children": "Altruism",
    "Human Rights": "Equality",
    "Civil Rights and Social Action": "Equality",
    "Arts and Culture": "Creativity",
    "Health": "Empathy",
    "Disaster and Humanitarian Relief": "Empathy",
    "Animal Welfare": "Empathy",
    "Poverty Alleviation": "Empathy",
    "Social Services": "Equity",
    "Environment": "Environment",
}

# What other features say about a person.
TOP_UNIVERSITY_VALUES = ["Excellence", "Learning"]
DOCTORATE_VALUES = ["Excellence", "Autonomy", "Learning"]
NONPROFIT_VALUES = ["Contribution", "Meaningful work", "Community"]
SELF_EMPLOYED_VALUES = ["Accountability", "Autonomy"]

# Core values and the words that show them, in order of precedence.
CORE_VALUES = {
    "Accountability": ["responsibility", "responsible", "ownership", "reliability"],
    "Adaptability": ["flexible", "resilient", "versatile", "adaptive"],
    "Achievement": ["accomplishment", "success", "victory", "performance", "productivity"],
    "Passion": ["passion", "dedication", "enthousiasm", "commitment"],
    "Empathy": ["compassion", "kindness", "benevolence", "charity", "empathy"],
    "Collaboration": ["cooperation", "teamwork", "partnership", "collaborative", "collaboration", "synergy"],
    "Communication": ["dialogue", "interaction", "exchanging", "communicate"],
    "Community": ["society", "collective", "network"],
    "Creativity": ["originality", "creativity", "artist"],
    "Altruism": ["generosity", "altruism", "nonprofit"],
    "Contribution": ["donation", "engagement", "participation", "involvement"],
    "Innovation": ["creative", "ingenuity", "inventive", "innovation", "visionary"],
    "Diversity": ["inclusion", "heterogeneity", "diversity", "multiculturalism"],
    "Environment": [
        "sustainability", "eco", "environment", "ecology", "eco-friendly", "long-term viability",
        "conservation", "renewability", "green",
    ],
    "Equality": ["equity", "fairness", "impartiality", "evenness"],
    "Growth": ["development", "progress", "advancement", "expansion"],
    "Work Ethic": ["professionalism", "ethic", "diligence"],
    "Integrity": ["honesty", "authenticity", "fair", "sincere", "openness"],
    "Leadership": ["guidance", "directive", "influent", "authority"],
    "Learning": ["knowledge", "training", "self-improvement"],
    "Perseverance": ["determination", "tenacity", "resolve", "steadfastness"],
    "Respect": ["admiration", "regard", "deference", "esteem"],
    "Balance": ["stability", "equilibrium", "wellness", "balance"],
    "High Standards": ["quality", "excellence", "expertise"],
    "Meaningful work": ["meaningful"],
    "Autonomy": ["autonomy", "independant", "self driven"],
}

# English function words that are never keywords.
STOPWORDS = (
    "i me my myself we our ours ourselves you your yours yourself yourselves he him his himself "
    "she her hers herself it its itself they them their theirs themselves what which who whom "
    "this that these those am is are was were be been being have has had having do does did "
    "doing a an the and but if or because as until while of at by for with about against "
    "between into through during before after above below to from up down in out on off over "
    "under again further then once here there when where why how all any both each few more "
    "most other some such no nor not only own same so than too very s t can will just don "
    "should now d ll m o re ve y ain aren couldn didn doesn hadn hasn haven isn ma mightn "
    "mustn needn shan shouldn wasn weren won wouldn"
).split()

# Spellings of an "about us" link, in order of precedence.
ABOUT_PATTERNS = [
    "about[-_ ]?us|about",
    "our[-_ ]?story",
    "who[-_ ]?we[-_ ]?are|who[-_ ]?are[-_ ]?we",
    "about[-_ ]?our[-_ ]?company|our[-_ ]?company",
    "our[-_ ]?mission",
    "our[-_ ]?background",
    "meet[-_ ]?the[-_ ]?team",
    "what[-_ ]?we[-_ ]?do",
    "company[-_ ]?overview",
    "our[-_ ]?vision",
    "our[-_ ]?values",
    "corporate[-_ ]?info|corporate[-_ ]?information|corporate[-_ ]?details",
    "company[-_ ]?info|company[-_ ]?information|company[-_ ]?details",
    "get[-_ ]?to[-_ ]?know[-_ ]?us",
    "learn[-_ ]?more[-_ ]?about[-_ ]?us",
    "our[-_ ]?history",
    "the[-_ ]?team",
    "who[-_ ]?we[-_ ]?serve",
    "why[-_ ]?choose[-_ ]?us",
    "who[-_ ]?we[-_ ]?stand[-_ ]?for",
    "our[-_ ]?philosophy",
    "about[-_ ]?our[-_ ]?business",
    "our[-_ ]?journey",
]

# Elements whose content is never readable text.
UNREADABLE_TAGS = ["script", "style", "nav", "footer", "header", "aside"]


def _book(openings: list[str], closings: list[str]) -> list[str]:
    return [f"{a} {b}" for a, b in product(openings, closings)]


# Sentence books, one per kind of match. Each sentence is an opening and a closing.
BOOKS = {
    "value_both": _book(
        [
            "{company name} puts {core value} forward in its {company source}.",
            "The {company source} of {company name} speaks of {core value}.",
            "{core value} stands out in the {company source} of {company name}.",
            "Readers of the {company source} of {company name} meet {core value} at once.",
            "{company name} names {core value} in its {company source}.",
        ],
        [
            "Your {profile source} proves it, so place it near the top.",
            "Point to your {profile source} as evidence.",
        ],
    ),
    "value_company": _book(
        [
            "{company name} puts {core value} forward in its {company source}.",
            "The {company source} of {company name} speaks of {core value}.",
            "{core value} stands out in the {company source} of {company name}.",
            "Readers of the {company source} of {company name} meet {core value} at once.",
            "{company name} names {core value} in its {company source}.",
        ],
        ["Say where you have shown it.", "Give it a line of its own in your profile."],
    ),
    "value_profile": _book(
        [
            "{company name} cares about {core value}.",
            "{core value} counts at {company name}.",
            "People at {company name} look for {core value}.",
            "{company name} and you share {core value}.",
            "{core value} is a common ground with {company name}.",
        ],
        ["Your {profile source} proves it, so place it near the top.", "Point to your {profile source} as evidence."],
    ),
    "value_neither": _book(
        [
            "{company name} cares about {core value}.",
            "{core value} counts at {company name}.",
            "People at {company name} look for {core value}.",
            "{company name} and you share {core value}.",
            "{core value} is a common ground with {company name}.",
        ],
        ["Say where you have shown it.", "Give it a line of its own in your profile."],
    ),
    "volunteering": _book(
        [
            "The share of volunteers at {company name} is unusual.",
            "Volunteering sets the staff of {company name} apart.",
            "{company name} differs from others in how many people volunteer.",
            "Unpaid work is a mark of {company name}.",
            "Few traits tell {company name} apart as volunteering does.",
        ],
        ["List what you have done yourself.", "Move your volunteer work up."],
    ),
    "top_university": _book(
        [
            "Where people studied sets {company name} apart.",
            "Leading universities are a mark of {company name}.",
            "{company name} differs from others in where its staff studied.",
            "Alumni circles matter at {company name}.",
            "Few traits tell {company name} apart as its universities do.",
        ],
        ["Use {university name} to open doors.", "Write to people there who know {university name}."],
    ),
    "master": _book(
        [
            "Master's degrees set {company name} apart.",
            "The share of master's degrees at {company name} is unusual.",
            "{company name} differs from others in its master's degrees.",
            "A master's degree is a mark of {company name}.",
            "Few traits tell {company name} apart as master's degrees do.",
        ],
        ["Name yours early.", "Say what yours was about."],
    ),
    "doctorate": _book(
        [
            "Doctorates set {company name} apart.",
            "The share of doctorates at {company name} is unusual.",
            "{company name} differs from others in its doctorates.",
            "A doctorate is a mark of {company name}.",
            "Few traits tell {company name} apart as doctorates do.",
        ],
        ["Name yours early.", "Say what yours was about."],
    ),
    "theme": [
        "{company name} shows itself in {colors}; a background in these colours fits.",
        "The colours of {company name} are {colors}. Let your resume pick them up.",
        "Set your resume on {colors}, as {company name} does.",
        "Choose {colors} for accents to echo {company name}.",
        "A layout in {colors} sits well with {company name}.",
    ],
    "picture_keep": _book(
        [
            "Your photo looks {dominant profile emotion}, as do many at {company name}.",
            "A {dominant profile emotion} photo fits {company name}.",
            "The {dominant profile emotion} tone of your photo is that of {company name}.",
            "Staff photos at {company name} are {dominant profile emotion} like yours.",
            "{company name} and your photo share a {dominant profile emotion} tone.",
        ],
        ["Keep it.", "There is no need for a new one."],
    ),
    "picture_change": _book(
        [
            "Your photo looks {dominant profile emotion}, while {company name} looks {dominant company emotion}.",
            "A {dominant profile emotion} photo is rare at {company name}, where {dominant company emotion} ones prevail.",
            "Photos at {company name} are {dominant company emotion}; yours is {dominant profile emotion}.",
            "The {dominant profile emotion} tone of your photo differs from the {dominant company emotion} one of {company name}.",
            "{company name} prefers a {dominant company emotion} tone to a {dominant profile emotion} one.",
        ],
        ["Think about a new photo.", "Another photo may serve you better."],
    ),
}
