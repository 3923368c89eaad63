"""Lookup tables and rule lists. Every value here is a default: the functions take their own as arguments."""

from __future__ import annotations

from typing import NamedTuple


class Rule(NamedTuple):
    """One step of a rule ladder: values matching ``pattern`` get ``label``."""

    pattern: str
    label: str


# ---- Fixed values: they must be exactly these for right results. ----------------------------

OTHER_TAG = "[OTHERS]"
NO_TAGS = "[None]"

COUNTRY_ZONES = {
    "BR": "America/Sao_Paulo",
    "CA": "America/Toronto",
    "DE": "Europe/Berlin",
    "FR": "Europe/Paris",
    "GB": "Europe/London",
    "IN": "Asia/Kolkata",
    "JP": "Asia/Tokyo",
    "KR": "Asia/Seoul",
    "MX": "America/Mexico_City",
    "RU": "Europe/Moscow",
    "US": "America/New_York",
}

PLATFORMS = {"nflx": "Netflix", "amzn": "Amazon", "dsny": "Disney"}

RATING_CODES = {
    "TV-Y": 0,
    "TV-Y7": 7,
    "TV-Y7-FV": 7,
    "G": 0,
    "PG": 7,
    "PG-13": 13,
    "R": 16,
    "NC-17": 18,
    "TV-G": 0,
    "TV-PG": 7,
    "TV-14": 13,
    "TV-MA": 18,
    "ALL": 0,
    "ALL_AGES": 0,
    "16": 16,
    "18+": 18,
    "13+": 13,
    "7+": 7,
    "AGES_16_": 16,
    "AGES_18_": 18,
    "16+": 16,
    "NR": None,
    "UR": None,
    "UNRATED": None,
    "NOT_RATE": None,
    "TV-NR": None,
}

PITCH_NAMES = {
    0: "C", 1: "C#", 2: "D", 3: "D#", 4: "E", 5: "F",
    6: "F#", 7: "G", 8: "G#", 9: "A", 10: "A#", 11: "B",
}
MODE_NAMES = {0: "Minor", 1: "Major"}

# Character blocks of titles that need a translation.
JAPANESE = r"[\u3040-\u30FF\u31F0-\u31FF\uFF66-\uFF9F]"
ARABIC = r"[\u0600-\u06FF\u0750-\u077F\u08A0-\u08FF]"
KOREAN = r"[\uAC00-\uD7AF\u1100-\u11FF]"
CHINESE = r"[\u4E00-\u9FFF\u3400-\u4DBF]"
DEVANAGARI = r"[\u0900-\u097F]"
THAI = r"[\u0E00-\u0E7F]"
CYRILLIC = r"[\u0400-\u04FF]"
NON_LATIN_BLOCKS = [JAPANESE, ARABIC, KOREAN, CHINESE, DEVANAGARI, THAI]
NON_LATIN_AND_CYRILLIC_BLOCKS = [*NON_LATIN_BLOCKS, CYRILLIC]

TITLE_OVERRIDES = {
    "nflx2639": "1000 Congratulations",
    "nflx2640": "Cairo Class",
    "nflx4915": "Son of the Sea",
    "nflx5023": "The Chase",
    "nflx5975": "Evil Plan of the Cunning Man",
    "nflx6178": "Ninja Hattori-kun",
    "nflx7102": "Witch Hunt",
    "nflx7109": "The Strongest Warrior Mini Force: The Birth of Heroes",
    "nflx8775": "Judgment Day",
    "nflx8795": "Clash",
    "amzn8712": "Broker",
}

WORKOUT_PREFIXES = [
    "30-Minute", "30 Minutes", "16 Minute", "15-Minute", "10 Minute", "10 Day Yoga", "9-Minute",
    "9 Hour", "8 Minute", "8 Hours", "7 Minute", "6 Minutes", "5-Minute", "Yoga For",
]

NOT_A_TRAILER_TERMS = [
    "gameplay", "xbox", "valorant", "reaction", "call of duty", "league of legends",
    "mortal kombat", "resident evil", "diablo", "sims", "street fighter", "mario kart",
    "apex legends", "the legend of zelda", "tekken", "nintendo", "music video", "mv trailer",
    "RÉACTION", "overwatch", "super bowl", "game", "react", "legendado", "explicacion",
    "announcement", "Anúncio", "launch", "global trailer", "cities skylines", "announce",
    "mobile legends", "comeback trailer", "genshin impact", "reaccion", "among us", "ps5",
    "games", "breakdown", "justin bieber",
]

VIDEO_RENAMES = {
    "publishedAt": "published_at",
    "channelId": "channel_id",
    "channelTitle": "channel_title",
    "categoryId": "category_id",
}

# Music genre -> general genre; the first rule found in the genre decides.
MUSIC_GENRE_RULES = [
    Rule(".*metal.*", "metal"),
    Rule(".*trap.*", "trap"),
    Rule(".*hip hop.*", "rap"),
    Rule(".*rap.*", "rap"),
    Rule(".*pop.*", "pop"),
    Rule(".*indie.*", "indie"),
    Rule(".*rock.*", "rock"),
    Rule(".*r&b.*", "r&b"),
    Rule(".*edm.*", "edm"),
    Rule(".*house.*", "house"),
    Rule(".*instrumental.*", "instrumental"),
    Rule(".*afro.*", "afro"),
    Rule(".*jazz.*", "jazz"),
    Rule(".*blues.*", "blues"),
    Rule(".*country.*", "country"),
    Rule(".*classical.*", "classical"),
    Rule(".*reggae.*", "reggae"),
    Rule(".*folk.*", "folk"),
    Rule(".*soul.*", "soul"),
    Rule(".*funk.*", "funk"),
    Rule(".*punk.*", "punk"),
    Rule(".*disco.*", "disco"),
    Rule(".*techno.*", "techno"),
    Rule(".*dance.*", "dance"),
    Rule(".*drill.*", "drill"),
    Rule(".*hardstyle.*", "hardstyle"),
    Rule(".*electronic.*", "electronic"),
    Rule(".*core.*", "electronic"),
    Rule(".*lo-fi.*", "lo-fi"),
    Rule(".*alternative.*", "alternative"),
    Rule(".*bass.*", "bass"),
    Rule(".*urbano.*", "urbano"),
    Rule(".*phonk.*", "phonk"),
    Rule(".*trance.*", "trance"),
    Rule(".*brasileiro.*", "brazilian"),
    Rule(".*songwriter.*", "songwriter"),
    Rule(".*orchestral.*", "orchestral"),
]
OTHER_GENRE = "others"

# Catalogue genre list -> one label; each rule rewrites the line left by the rules before it.
CATALOGUE_GENRE_RULES = [
    Rule(".*adventure.*", "Adventure"),
    Rule(".*animals.*|.*nature.*", "Animals & Nature"),
    Rule(".*animation.*", "Animation"),
    Rule(".*anime.*", "Anime"),
    Rule(".*anthology.*", "Anthology"),
    Rule(".*arthouse.*", "Arthouse"),
    Rule(".*arts.*", "Arts"),
    Rule(".*biographical.*", "Biographical"),
    Rule(".*buddy.*", "Buddy"),
    Rule(".*children.*|.*family.*", "Children & Family"),
    Rule(".*classic.*", "Classic"),
    Rule(".*comedies.*|.*comedy.*", "Comedy"),
    Rule(".*coming of age.*", "Coming of Age"),
    Rule(".*crime.*", "Crime"),
    Rule(".*cult.*", "Cult"),
    Rule(".*dance.*", "Dance"),
    Rule(".*disaster.*", "Disaster"),
    Rule(".*documentaries.*|.*documentary.*|.*docuseries.*", "Documentary"),
    Rule(".*drama.*|.*dramas.*", "Drama"),
    Rule(".*entertainment.*", "Entertainment"),
    Rule(".*faith.*|.*spirituality.*", "Faith & Spirituality"),
    Rule(".*fantasy.*", "Fantasy"),
    Rule(".*game show.*|.*competition.*", "Game Show / Competition"),
    Rule(".*historical.*", "Historical"),
    Rule(".*horror.*", "Horror"),
    Rule(".*independent.*", "Independent"),
    Rule(".*international.*", "International"),
    Rule(".*kids.*", "Kids"),
    Rule(".*korean.*", "Korean"),
    Rule(".*lgbtq.*", "LGBTQ"),
    Rule(".*lifestyle.*", "Lifestyle"),
    Rule(".*medical.*", "Medical"),
    Rule(".*military.*|.*war.*", "Military and War"),
    Rule(".*music.*|.*musical.*|.*concert.*|.*videos.*", "Music"),
    Rule(".*mystery.*", "Mystery"),
    Rule(".*parody.*", "Parody"),
    Rule(".*police.*|.*cop.*", "Police/Cop"),
    Rule(".*reality.*", "Reality"),
    Rule(".*romance.*|.*romantic.*", "Romance"),
    Rule(".*sci-fi.*|.*science.*|.*fantasy.*", "Sci-Fi & Fantasy"),
    Rule(".*soap opera.*|.*melodrama.*", "Soap Opera / Melodrama"),
    Rule(".*spanish-language.*", "Spanish-Language"),
    Rule(".*special interest.*", "Special Interest"),
    Rule(".*sports.*", "Sports"),
    Rule(".*spy.*|.*espionage.*", "Spy/Espionage"),
    Rule(".*stand-up.*|.*talk show.*|.*variety.*", "Stand-Up Comedy & Talk Shows"),
    Rule(".*superhero.*", "Superhero"),
    Rule(".*survival.*", "Survival"),
    Rule(".*suspense.*", "Suspense"),
    Rule(".*teen.*", "Teen"),
    Rule(".*thriller.*|.*thrillers.*", "Thriller"),
    Rule(".*travel.*", "Travel"),
    Rule(".*unscripted.*", "Unscripted"),
    Rule(".*western.*", "Western"),
    Rule(".*young adult.*", "Young Adult Audience"),
]

# Video tag -> main tag; the last rule found in the tag decides.
TAG_RULES = [
    Rule(r"\bgaming\b|\bgameplay\b|\bgamer\b", "gaming"),
    Rule(r"\bvideo ?gam(e|ing)\b", "gaming"),
    Rule(r"\bmine ?craft\b", "minecraft"),
    Rule(r"\b(comedy|funny|skit|laugh|humou?r|prank)\b", "comedy"),
    Rule(r"\bvlogs?\b", "vlog"),
    Rule(r"\bnews\b", "news"),
    Rule(r"\btrailer\b", "trailer"),
    Rule(r"\bmovie\b", "movie"),
    Rule(r"\bmusic\b", "music"),
    Rule(r"\bcooking\b", "food"),
    Rule(r"\bfood\b", "food"),
    Rule(r"\bchallenge\b", "challenge"),
    Rule(r"\banimation\b", "animation"),
    Rule(r"\bsports?\b", "sports"),
    Rule(r"\be[ -]?sports?", "e-sports"),
    Rule(r"\bpewdiepie\b", "pewdiepie"),
    Rule(r"\byou ?tube\b", "youtube"),
    Rule(r"\bfashion\b", "fashion"),
    Rule(r"\bpolitic(s|al)?\b", "politics"),
    Rule(r"\bbasketball\b", "basketball"),
    Rule(r"\bnba\b", "nba"),
    Rule(r"\bnfl\b", "nfl"),
    Rule(r"\bfort[ -]?nite\b", "fortnite"),
    Rule(r"\bmarvel\b", "marvel"),
    Rule(r"\bsoccer\b", "soccer"),
    Rule(r"foot[ -]?ball", "football"),
    Rule(r"\bcar\b", "car"),
    Rule(r"\brap\b", "rap"),
    Rule(r"\brapper?s\b", "rap"),
    Rule(r"\bscience?s\b", "sciencce"),
    Rule(r"\beducation\b", "education"),
    Rule(r"\b(streaming|twitch)\b", "streaming"),
    Rule(r"\bmma\b", "mma"),
    Rule(r"\bwrestling\b", "wrestling"),
    Rule(r"\bpodcast?s\b", "podcast"),
    Rule(r"\bsmosh\b", "smosh"),
    Rule(r"\bdocumentary\b", "documentary"),
    Rule(r"\binterview?s\b", "interview"),
    Rule(r"\bcommentary\b", "commentary"),
    Rule(r"\breaction?s\b", "reaction"),
    Rule(r"\btutorial?s\b", "tutorial"),
    Rule(r"\bbts\b", "bts"),
    Rule(r"\btennis\b", "tennis"),
    Rule(r"\bgrand ?slam\b", "tennis"),
    Rule(r"\bgame dev\b", "gamedev"),
    Rule(r"\bviral\b", "viral"),
    Rule(r"\bdisney\b", "disney"),
    Rule(r"\bmeme\b", "meme"),
    Rule(r"\bmr ?beast\b", "mrbeast"),
    Rule(r"\bchess\b", "chess"),
    Rule(r"\banime\b", "anime"),
    Rule(r"\bhorror\b", "horror"),
    Rule(r"\bacting\b", "acting"),
    Rule(r"\bdanc(e|ing)\b", "dancing"),
    Rule(r"\b(family|child|kid)[ -]?friendly\b", "familyfriendly"),
    Rule(r"lgbt|\bgay\b|\btrans\b|\bqueer\b", "lgbt"),
    Rule(r"\bamon?g ?us", "among us"),
    Rule(r"skibidi", "skibidi"),
    Rule(r"\bhistory\b", "history"),
    Rule(r"\bcelebrity\b", "celebrity"),
    Rule(r"\bk[ -]?pop\b", "k-pop"),
]

# Units of each currency that buy one euro.
UNITS_PER_EURO = {
    "EUR": 1, "AED": 4.0698, "AFN": 77.2396, "ALL": 99.486, "AMD": 429.0821, "ANG": 1.9837,
    "AOA": 1048.5841, "ARS": 1065.8065, "AUD": 1.6522, "AWG": 1.9837, "AZN": 1.885, "BAM": 1.9558,
    "BBD": 2.2164, "BDT": 132.2458, "BGN": 1.9558, "BHD": 0.4167, "BIF": 3201.8381, "BMD": 1.1082,
    "BND": 1.4373, "BOB": 7.6223, "BRL": 6.2265, "BSD": 1.1082, "BTN": 92.8397, "BWP": 14.7494,
    "BYN": 3.6139, "BZD": 2.2164, "CAD": 1.5054, "CDF": 3141.9907, "CHF": 0.94, "CLP": 1034.8253,
    "CNY": 7.8654, "COP": 4660.4429, "CRC": 573.8529, "CUP": 26.5967, "CVE": 110.265, "CZK": 25.1493,
    "DJF": 196.9495, "DKK": 7.4602, "DOP": 65.9131, "DZD": 146.8965, "DEM": 1.95583, "EGP": 53.6959,
    "ERN": 16.6229, "ESP": 166.386, "ETB": 125.7132, "FJD": 2.4564, "FKP": 0.8448, "FRF": 6.55957,
    "FOK": 7.4602, "GBP": 0.8448, "GEL": 2.9878, "GGP": 0.8448, "GHS": 17.833, "GIP": 0.8448,
    "GMD": 78.2166, "GNF": 9595.5348, "GTQ": 8.5297, "GYD": 230.427, "HKD": 8.6431, "HNL": 27.3378,
    "HRK": 7.5345, "HTG": 145.0358, "HUF": 395.221, "IDR": 17078.0349, "ILS": 4.1139, "IMP": 0.8448,
    "INR": 92.8401, "IQD": 1442.8884, "IRR": 46853.3296, "ISK": 152.3013, "JEP": 0.8448,
    "JMD": 173.1031, "JOD": 0.7857, "JPY": 156.2202, "KES": 143.0534, "KGS": 93.6238, "KHR": 4482.5733,
    "KID": 1.6524, "KMF": 491.9678, "KRW": 1473.6263, "KWD": 0.3381, "KYD": 0.9235, "KZT": 532.4556,
    "LAK": 24405.9975, "LBP": 99183.4517, "LKR": 333.4807, "LRD": 219.9283, "LSL": 19.6649,
    "LYD": 5.2488, "MAD": 10.8175, "MDL": 19.2813, "MGA": 4973.34, "MKD": 61.495, "MMK": 3589.7952,
    "MNT": 3772.9986, "MOP": 8.9019, "MRU": 43.7751, "MUR": 50.8276, "MVR": 17.0956, "MWK": 1934.3096,
    "MXN": 21.3005, "MYR": 4.7732, "MZN": 70.7864, "NAD": 19.6649, "NGN": 1831.1153, "NIO": 40.5863,
    "NOK": 11.7963, "NPR": 148.5435, "NZD": 1.7981, "OMR": 0.4261, "PAB": 1.1082, "PEN": 4.182,
    "PGK": 4.3313, "PHP": 62.0363, "PKR": 308.4382, "PLN": 4.2828, "PYG": 8554.8931, "QAR": 4.0338,
    "RON": 4.974, "RSD": 117.0549, "RUB": 100.5048, "RUR": 100.5048, "RWF": 1513.6375, "SAR": 4.1557,
    "SBD": 9.3751, "SCR": 15.1528, "SDG": 492.2299, "SEK": 11.3334, "SGD": 1.4374, "SHP": 0.8448,
    "SLE": 25.0451, "SLL": 25045.103, "SOS": 629.5749, "SRD": 33.4587, "SSP": 3705.6617, "STN": 24.5,
    "SYP": 14392.9983, "SZL": 19.6649, "THB": 36.9754, "TJS": 11.7919, "TMT": 3.8792, "TND": 3.367,
    "TOP": 2.5753, "TRY": 37.6999, "TRL": 37.6999, "TTD": 7.5794, "TVD": 1.6524, "TWD": 35.415,
    "TZS": 3006.3964, "UAH": 45.8354, "UGX": 4113.8011, "$": 1.1082, "UYU": 44.6903, "UZS": 14192.7842,
    "VES": 40.7781, "VND": 27183.4385, "VUV": 130.6163, "WST": 2.9899, "XAF": 655.957, "XCD": 2.9921,
    "XDR": 0.8214, "XOF": 655.957, "XPF": 119.332, "YER": 277.574, "ZAR": 19.6594, "ZMW": 29.1952,
    "ZWL": 15.4638,}

# ---- End of the fixed values. ---------------------------------------------------------------

# Repaired forms of tag rules whose pattern needs a plural "s" it should only allow, or whose label is misspelt.
REPAIRED_TAG_RULES = {
    r"\brapper?s\b": Rule(r"\brappers?\b", "rap"),
    r"\bscience?s\b": Rule(r"\bsciences?\b", "science"),
    r"\bpodcast?s\b": Rule(r"\bpodcasts?\b", "podcast"),
    r"\binterview?s\b": Rule(r"\binterviews?\b", "interview"),
    r"\breaction?s\b": Rule(r"\breactions?\b", "reaction"),
    r"\btutorial?s\b": Rule(r"\btutorials?\b", "tutorial"),
}


def repaired_tag_rules() -> list[Rule]:
    """The tag rules with the faulty ones replaced; pass them as ``rules`` to use them."""
    return [REPAIRED_TAG_RULES.get(rule.pattern, rule) for rule in TAG_RULES]
