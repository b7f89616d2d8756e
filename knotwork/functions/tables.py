"""Lookup tables of the normalizers."""

from __future__ import annotations

import unicodedata

# --- Fixed values: names, codes, terms and patterns that results depend on. ---

BRAHMIC_STARTS = (0x0900, 0x0980, 0x0A00, 0x0A80, 0x0B00, 0x0B80, 0x0C00, 0x0C80, 0x0D00)
INDIC_VOWELS = {
    0x04: "a", 0x05: "a", 0x06: "aa", 0x07: "i", 0x08: "ii", 0x09: "u", 0x0A: "uu",
    0x0B: "ri", 0x0E: "e", 0x0F: "e", 0x10: "ai", 0x12: "o", 0x13: "o", 0x14: "au",
}
INDIC_CONSONANTS = {
    0x15: "k", 0x16: "kh", 0x17: "g", 0x18: "gh", 0x19: "ng",
    0x1A: "ch", 0x1B: "chh", 0x1C: "j", 0x1D: "jh", 0x1E: "ny",
    0x1F: "t", 0x20: "th", 0x21: "d", 0x22: "dh", 0x23: "n",
    0x24: "t", 0x25: "th", 0x26: "d", 0x27: "dh", 0x28: "n", 0x29: "nn",
    0x2A: "p", 0x2B: "ph", 0x2C: "b", 0x2D: "bh", 0x2E: "m",
    0x2F: "y", 0x30: "r", 0x31: "r", 0x32: "l", 0x33: "l", 0x34: "l",
    0x35: "v", 0x36: "sh", 0x37: "sh", 0x38: "s", 0x39: "h",
    0x58: "q", 0x59: "kh", 0x5A: "gh", 0x5B: "z", 0x5C: "r", 0x5D: "rh", 0x5E: "f", 0x5F: "y",
}
INDIC_MATRAS = {
    0x3E: "aa", 0x3F: "i", 0x40: "ii", 0x41: "u", 0x42: "uu",
    0x43: "ri", 0x46: "e", 0x47: "e", 0x48: "ai", 0x4A: "o", 0x4B: "o", 0x4C: "au",
}
INDIC_NASALS = (0x02, 0x03)
VIRAMA = 0x4D

US_STATES = {
    "alabama": "al", "alaska": "ak", "arizona": "az", "arkansas": "ar", "california": "ca",
    "colorado": "co", "connecticut": "ct", "delaware": "de", "florida": "fl", "georgia": "ga",
    "hawaii": "hi", "idaho": "id", "illinois": "il", "indiana": "in", "iowa": "ia",
    "kansas": "ks", "kentucky": "ky", "louisiana": "la", "maine": "me", "maryland": "md",
    "massachusetts": "ma", "michigan": "mi", "minnesota": "mn", "mississippi": "ms", "missouri": "mo",
    "montana": "mt", "nebraska": "ne", "nevada": "nv", "new hampshire": "nh", "new jersey": "nj",
    "new mexico": "nm", "new york": "ny", "north carolina": "nc", "north dakota": "nd", "ohio": "oh",
    "oklahoma": "ok", "oregon": "or", "pennsylvania": "pa", "rhode island": "ri", "south carolina": "sc",
    "south dakota": "sd", "tennessee": "tn", "texas": "tx", "utah": "ut", "vermont": "vt",
    "virginia": "va", "washington": "wa", "west virginia": "wv", "wisconsin": "wi", "wyoming": "wy",
    "district of columbia": "dc", "puerto rico": "pr", "virgin islands": "vi", "guam": "gu",
}
INDIA_STATES = {
    "maharashtra": "mh", "maharashtra state": "mh", "delhi": "dl", "new delhi": "dl", "nct of delhi": "dl",
    "gujarat": "gj", "karnataka": "ka", "tamil nadu": "tn", "tamilnadu": "tn", "west bengal": "wb",
    "westbengal": "wb", "uttar pradesh": "up", "telangana": "ts", "andhra pradesh": "ap", "kerala": "kl",
    "rajasthan": "rj", "haryana": "hr", "punjab": "pb", "madhya pradesh": "mp", "bihar": "br",
    "odisha": "od", "orissa": "od", "assam": "as", "jharkhand": "jh", "chhattisgarh": "cg",
    "uttarakhand": "uk", "uttaranchal": "uk", "himachal pradesh": "hp", "goa": "ga",
    "jammu and kashmir": "jk", "jammu & kashmir": "jk", "chandigarh": "ch", "puducherry": "py",
    "pondicherry": "py", "tripura": "tr", "meghalaya": "ml", "manipur": "mn", "nagaland": "nl",
    "arunachal pradesh": "ar", "mizoram": "mz", "sikkim": "sk",
}
INDIA_SCRIPTS = {
    "महाराष्ट्र": "mh", "ગુજરાત": "gj", "दिल्ली": "dl", "ಕರ್ನಾಟಕ": "ka", "தமிழ்நாடு": "tn",
    "पश्चिम बंगाल": "wb", "उत्तर प्रदेश": "up", "राजस्थान": "rj", "पंजाब": "pb",
}
#: Only regions of two words can ever be met by the two-word lookup.
FRANCE_REGIONS = ("nouvelle aquitaine", "grand est")

LEGAL_TERMS = (
    "private limited", "pvt ltd", "pvt limited", "private ltd", "pribbte limited", "pfviate limited",
    "priave limited", "pty ltd", "pty limited", "public limited", "limited liability company",
    "limited liability partnership", "joint stock company", "incorporated", "corporation", "association",
    "inc", "corp", "llc", "ltd", "co", "company", "llp", "pllc", "lp", "pc", "pa",
    "sarl", "sasu", "sas", "eurl", "sci", "snc", "sa", "gmbh", "ag",
    "holding", "holdings", "enterprises", "enterprise", "services", "industries", "industry",
)
LEGAL_CANONICAL = {
    "private limited": "pvt_ltd", "private ltd": "pvt_ltd", "pvt limited": "pvt_ltd", "pvt ltd": "pvt_ltd",
    "public limited": "pub_ltd", "pty ltd": "pty_ltd", "pty limited": "pty_ltd",
    "limited liability company": "llc", "llc": "llc", "limited liability partnership": "llp", "llp": "llp",
    "pllc": "pllc", "incorporated": "inc", "inc": "inc", "corporation": "corp", "corp": "corp",
    "limited": "ltd", "ltd": "ltd", "company": "co", "co": "co", "sarl": "sarl", "sasu": "sasu",
    "sas": "sas", "eurl": "eurl", "gmbh": "gmbh",
}

#: Without dotted forms: punctuation is gone before the lookup.
ADDRESS_EXPANSIONS = {
    "st": "street", "str": "street", "rd": "road", "ave": "avenue", "av": "avenue", "dr": "drive",
    "blvd": "boulevard", "pkwy": "parkway", "pky": "parkway", "hwy": "highway", "ln": "lane", "ct": "court",
    "cir": "circle", "pl": "place", "sq": "square", "ter": "terrace", "trl": "trail", "expy": "expressway",
    "r": "rue", "bd": "boulevard", "bvd": "boulevard", "imp": "impasse", "ch": "chemin", "rte": "route",
    "all": "allee", "ste": "suite", "apt": "unit", "apartment": "unit", "bldg": "building", "fl": "floor",
    "rm": "room", "dept": "department", "n": "north", "s": "south", "e": "east", "w": "west",
    "ne": "northeast", "nw": "northwest", "se": "southeast", "sw": "southwest", "nr": "near", "opp": "opposite",
}

#: (pattern, replacement) in order, over folded lower-case ASCII text. Java syntax.
CLEANING = (
    (r"\belaelapii\b", "llp"),
    (r"\bpra+ive?t[ta]?[\s\x1c-\x1f]+limite?t[ta]?\b", "private limited"),
    (r"\bpra+ive?t[ta]?\b", "private"),
    (r"\blimite?t[ta]?\b", "limited"),
    (r"\bindiyana\b", "indian"),
    (r"\binphraa?\b", "infra"),
    (r"https?://(?:www\.)?([^\s\x1c-\x1f]+)", " $1 "),
    (r"\b(?:www\.)?([a-z0-9_\-]+)\.(?:com|org|net|edu|co\.in|in|fr)\b", " $1 "),
    (r"\b\w+@\w+\.\w+\b", " "),
    (r"\b(?:null|<null>|none|nan)\b", " "),
    (r"\b(?:d/?b/?a|a/?k/?a|f/?k/?a|t/?a|c/?o|m/?s)\b", " "),
    (r"^[#*><@|~`!_+=/\\-]+", " "),
    (r"[^a-z0-9]+", " "),
)
UNIT_PATTERN = r"\b(?:suite|ste|unit|apt|apartment|fl|floor|rm|room|#)\s*([a-z0-9\-]+)"
LEADING_NUMBER_PATTERN = r"^\s*\d+[\w\-]*\s*"
UNIT_PHRASE_PATTERN = r"\b(?:suite|unit|apartment|floor|room|ste|apt|fl|rm)\s*[a-z0-9\-]+"

SOUNDEX_GROUPS = {"BFPV": "1", "CGJKQSXZ": "2", "DT": "3", "L": "4", "MN": "5", "R": "6"}
BLOCKING_STOPWORDS = (
    "and", "the", "of", "for", "in", "at", "to", "a", "an", "co", "company", "corp", "corporation", "inc",
    "incorporated", "ltd", "limited", "pvt", "llc", "gmbh", "sarl", "sa", "bv", "center", "services",
    "group", "holdings", "enterprise",
)
GENERIC_STREET_WORDS = ("street", "road", "avenue", "drive", "lane", "boulevard", "unit")

# --- End of fixed values. ---


def _folds() -> tuple[dict[str, str], dict[str, str]]:
    """Characters whose compatibility decomposition leaves one ASCII character, and those that leave several."""
    one, many = {}, {}
    for cp in range(0x80, 0x110000):
        if 0xAC00 <= cp <= 0xD7A3 or 0xD800 <= cp <= 0xDFFF:
            continue
        c = chr(cp)
        left = unicodedata.normalize("NFKD", c).encode("ascii", "ignore").decode()
        if len(left) == 1:
            one[c] = left
        elif left:
            many[c] = left
    return one, many


FOLD_ONE, FOLD_MANY = _folds()
