"""Names of ships as people type them, taken apart.

A name becomes a small record: the kind of ship its prefix tells, a leading given name or
title, a number at its end, and the rest (the stem) as plain letters run together, so that
hyphens, blanks, accents, case, quotes, footnote marks and the order "Stem, Given" no
longer matter.
"""

from __future__ import annotations

import re
import unicodedata
from typing import NamedTuple

# Kinds of ship, as the prefix before a name tells them.
PREFIXES = (
    "ss ms mt mv ps sv fv mfv tss hms uss sms hnoms hnlms rms hmas hmcs hmnzs usns uscgc rmmv sy rv cs lv ts hdms hswms kms css "
    "ins orp fs hmt smu ijn tcg ara bns usat hmy"
).split()
# Prefixes written out.
WRITTEN_OUT = {
    "motor vessel": "mv", "motor ship": "ms", "motorship": "ms", "motor tanker": "mt", "steamship": "ss", "steam ship": "ss", "steamer": "ss", "paddle steamer": "ps", "sailing vessel": "sv",
    "fishing vessel": "fv", "motor fishing vessel": "mfv", "turbine steamship": "tss", "turbine steamer": "tss", "twin screw steamer": "tss", "twin-screw steamer": "tss",
    "hm ship": "hms", "h m ship": "hms", "his majestys ship": "hms", "her majestys ship": "hms", "us ship": "uss", "united states ship": "uss",
}
# Titles and their short forms.
TITLES = {
    "president": "pres", "admiral": "adm", "governor": "gov", "saint": "st", "mount": "mt", "lieutenant": "lt", "commander": "cdr", "captain": "capt",
    "doctor": "dr", "professor": "prof", "general": "gen", "princess": "pss", "colonel": "col", "major": "maj", "sergeant": "sgt",
}
# Given names with the short forms in use for them.
GIVEN = {
    "abigail": "abby gail", "alexander": "sandy alec alex alick", "andrew": "andy drew", "anthony": "tony", "benjamin": "ben benny", "catherine": "cathy kate", "charles": "charlie chas chuck",
    "christopher": "chris kit", "daniel": "dan danny", "dorothy": "dolly dot dottie", "edward": "ned ted eddie ed", "eleanor": "nell nellie ellie", "elizabeth": "betsy betty bess bessie lizzie liz eliza",
    "florence": "flo", "francis": "frank", "frederick": "fred freddie freddy", "george": "geo", "harold": "harry hal", "henry": "hank", "james": "jim jimmy jamie", "john": "jack johnny",
    "joseph": "joe", "josephine": "josie jo", "katherine": "kitty kathy", "leonard": "len lenny", "margaret": "peggy maggie meg madge", "martha": "patty", "mary": "polly molly",
    "michael": "mike mick", "nicholas": "nick", "patrick": "paddy", "rebecca": "becky", "richard": "dick rick", "robert": "bob rob bobby", "samuel": "sam", "sarah": "sally",
    "susannah": "sukey susan sue", "theodore": "theo", "thomas": "tom tommy", "victoria": "vicky vickie", "walter": "walt", "william": "bill will billy",
}
# What stands for no name.
NAMELESS = {
    "unknown", "unnamed", "unidentified", "unidentified vessel", "unknown vessel", "unidentified wreck", "unknown wreck", "unknown ship", "unnamed vessel", "no name", "nameless", "none", "null",
    "n a", "na", "not known", "not named", "wreck", "wk", "obstruction", "obstn", "hulk", "vessel", "ship", "unidentified ship", "unidentified object", "uncharted", "name unknown", "various",
    "barge", "boat", "wreckage", "remains", "foul", "foul ground", "",
}
# Things on a chart that are no ships.
NO_SHIP = {"pile", "piles", "fish haven", "buoy anchor", "well", "wellhead", "crib", "platform", "snag", "stump", "dolphin pile", "pipe", "pipeline", "cable", "anchor", "rock", "dolphin", "dolphins", "mooring", "mooring buoy", "diffuser"}

_NICK = {s: full for full, shorts in GIVEN.items() for s in shorts.split()}
_SHORT_TITLE = {s: t for t, s in TITLES.items()}
_ROMAN = {r: i + 1 for i, r in enumerate("i ii iii iv v vi vii viii ix x xi xii xiii xiv xv xvi xvii xviii xix xx".split())}
_OUT = re.compile(r"^(?:" + "|".join(sorted(map(re.escape, WRITTEN_OUT), key=lambda w: -len(w))) + r")\b")
_OUT_FIRST, _PREFIX_SET = {w[0] for w in WRITTEN_OUT}, set(PREFIXES)
_FOLD = str.maketrans({"ø": "o", "œ": "oe", "æ": "ae", "ß": "ss", "ł": "l", "đ": "d", "ð": "d", "þ": "th", "ı": "i", "’": "'", "‘": "'", "“": '"', "”": '"', "–": "-", "—": "-"})
_MARKS = re.compile(r"\[(?:\d+|[a-z]|note \d+|nb \d+|citation needed)\]")
_DOTTED = re.compile(r"(?<![a-z])(?:[a-z][./]){1,4}[a-z]\.?(?![a-z])|(?<![a-z])[a-z]/[a-z](?![a-z])")
_WRECK_OF = re.compile(r"^(?:(?:the )?(?:wreck|wk|rems?|remains|wreckage|hulk)\.? of (?:the )?)+")
_AFTER = re.compile(r"[\s,]+(?:\(?(?:pa|pd|ed|rep|wk|wreck|sub|pos approx)\)?)\.?$")


_INSIDE, _BRACKETS, _NO_LETTERS, _WORD = re.compile(r"\(([^)]*)\)"), re.compile(r"\([^)]*\)?"), re.compile(r"[\W\d_]+"), re.compile(r"[^\W\d_]+|\d+")
_NUMBER = re.compile(r"[\s,-]*(?:\bno\.? ?|#|-|\bnr\.? ?|\bnumber )?\b(\d{1,4})$")
_END, _AND, _INITIAL = re.compile(r"[\s,#-]+$|\s+no\.?$"), re.compile(r"\s*(?:&|\+)\s*| and "), re.compile(r"[a-z]\. ")
# a letter or a few and a number: the name of many a submarine or boat of a class
_DESIGNATION = re.compile(r"([^\W\d_]{1,3})[ -]?(\d{1,4})")
_TAILS = ("pa", "pd", "ed", "rep", "wk", "wreck", "sub", "approx")
_NAMELESS_FIRST = {w.split(" ")[0] for w in NAMELESS} | {""}


class Name(NamedTuple):
    stem: str  # letters of the name proper, run together
    given: str  # a full given name or title, a short form with a point, an initial, or ''
    number: int  # the number at the end, 0 for none
    prefix: str
    year: int  # a year in brackets, 0 for none
    words: tuple  # the words of the stem


def fold(text: str) -> str:
    if text.isascii():
        return text.lower()
    text = unicodedata.normalize("NFKD", text.casefold().translate(_FOLD))
    return "".join(c for c in text if not unicodedata.combining(c) and unicodedata.category(c) not in ("Cf", "Cc"))


def _given(word: str, dotted: bool, rest: bool, mount: bool) -> str:
    """The given name or title that a leading word is, or ''."""
    if not rest:
        return ""
    if word in GIVEN or word in TITLES:
        return word
    if word in _SHORT_TITLE and (word != "mt" or dotted or mount):
        return _SHORT_TITLE[word]
    if word in _NICK:
        return _NICK[word]
    if len(word) == 1 and ord(word) < 0x2E80:  # a single sign of an ideographic script is no initial
        return word
    if dotted and len(word) >= 3:
        return word + "."
    if len(word) >= 4:
        full = _TURNED.get(word) or _CUT.get(word)
        for i in range(len(word) if not full else 0):
            full = _CUT.get(word[:i] + word[i + 1 :])
            if full:
                break
        if full and (word in _TURNED or within(word, full, 1)):
            return full
    return ""


# Given names and titles of five letters or more with two neighbours turned, or one letter cut out.
_LONG = [n for n in (*GIVEN, *TITLES) if len(n) >= 5]
_TURNED = {n[:i] + n[i + 1] + n[i] + n[i + 2 :]: n for n in _LONG for i in range(len(n) - 1)}
_CUT = {n[:i] + n[i + 1 :]: n for n in _LONG for i in range(len(n))} | {n: n for n in _LONG}


def within(a: str, b: str, most: int) -> bool:
    return distance(a, b, most) <= most


def distance(a: str, b: str, most: int = 99) -> int:
    """Levenshtein distance, or more than ``most`` as soon as that is certain."""
    if a == b:
        return 0
    if abs(len(a) - len(b)) > most:
        return most + 1
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        diagonal, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            diagonal, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, diagonal + (x != y))
        if min(row) > most:
            return most + 1
    return row[-1]


def _prefix(text: str) -> tuple[str, str]:
    m = _OUT.match(text) if text[:1] in _OUT_FIRST else None
    if m and len(text) > m.end():
        return WRITTEN_OUT[m.group()], text[m.end() :].strip()
    word, _, rest = text.partition(" ")
    bare = word if word.isalpha() else word.replace("/", "").replace(".", "")
    if bare in _PREFIX_SET and rest and word != "mt.":
        return bare, rest.strip()
    return "", text


def parse(raw: str | None) -> Name | None:
    """The parts of a ship's name; None where there is none (empty, a placeholder, no ship)."""
    if not raw:
        return None
    t = fold(raw)
    if "[" in t:
        t = _MARKS.sub("", t)
    t = " ".join(t.replace('"', " ").split()).strip(" '.,;:|")
    if not t:
        return None
    if " of " in t:
        t = _WRECK_OF.sub("", t)
    prefix, year = "", 0
    for inside in _INSIDE.findall(t) if "(" in t else ():
        inside = inside.strip()
        if re.fullmatch(r"1[5-9]\d\d|20\d\d", inside):
            year = int(inside)
        else:
            p = WRITTEN_OUT.get(inside) or inside.replace(".", "").replace("/", "")
            if p in PREFIXES:
                prefix = p
    if "(" in t:
        t = _BRACKETS.sub(" ", t)
    while t.rstrip(" .)").endswith(_TAILS):
        cut = _AFTER.sub("", t).strip(" ,;")
        if cut == t:
            break
        t = cut
    if (t.partition(" ")[0] in _NAMELESS_FIRST or not t[:1].isalpha()) and _NO_LETTERS.sub(" ", t).strip() in NAMELESS:
        return None
    if "." in t or "/" in t:
        if not _INITIAL.match(t):
            t = _DOTTED.sub(lambda m: m.group().replace(".", "").replace("/", "") + (" " if m.group().endswith(".") else ""), t)
    t = " ".join(t.split())
    p, t = _prefix(t)
    prefix = p or prefix
    if "," in t:
        head, _, tail = t.partition(",")
        tail = tail.strip()
        if tail and head.strip():
            p2 = WRITTEN_OUT.get(tail.rstrip(".")) or tail.replace(".", "").replace("/", "")
            if p2 in PREFIXES and p2 != "mt":
                prefix, t = prefix or p2, head
            else:
                t = f"{tail} {head}"
            p, t = _prefix(t)
            prefix = prefix or p
    t = t.strip()
    if t.startswith("the ") and len(t) > 4:
        t = t[4:]
        p, t = _prefix(t)
        prefix = prefix or p
    number = 0
    m = _NUMBER.search(t) if t[-1:].isdigit() else None
    plain = _DESIGNATION.fullmatch(t) if t[-1:].isdigit() else None
    if plain:
        t, number = plain[1], int(plain[2])
    elif m and m.start() > 0:
        number, t = int(m.group(1)), t[: m.start()]
    else:
        head, _, last = t.rpartition(" ")
        if head and last in _ROMAN and last != "i":
            number, t = _ROMAN[last], head
    t = _END.sub("", t)
    if "&" in t or "+" in t or " and " in t:
        t = " ".join(sorted(_AND.split(t), key=lambda w: (len(w) < 9, w)))  # the order of two names joined by "and" tells nothing
    first, _, rest = t.partition(" ")
    words = _WORD.findall(rest.replace("'", ""))
    given = _given(first if first.isalpha() else _NO_LETTERS.sub("", first), first.endswith("."), bool(words), prefix != "")
    if not given:
        words = _WORD.findall(t.replace("'", ""))
    stem = "".join(words)
    plain = " ".join(words)
    if plain in NAMELESS or plain in NO_SHIP or not stem or stem.isdigit() or (len(stem) == 1 and not number):
        return None
    return Name(stem, given, number, prefix, year, tuple(words))


def same_given(a: str, b: str) -> bool | None:
    """Whether two given names can be one: None if just one of them is told."""
    if a == b:
        return True
    if not a or not b:
        return None
    x, y = a.rstrip("."), b.rstrip(".")
    if len(x) == 1 or len(y) == 1 or a.endswith(".") or b.endswith("."):
        return x.startswith(y) or y.startswith(x)
    return False


# Countries with the other names, adjectives, codes and services in use for them.
COUNTRIES = {
    "gb": "united kingdom|uk|gb|great britain|united kingdom of gb & ireland|british|britain|royal navy|england|british empire",
    "us": "united states|usa|us|american|united states of america|united states navy|us navy|union navy|confederate states",
    "de": "germany|de|german|german empire|nazi germany|deutschland|imperial german navy|kriegsmarine|west germany|prussia|weimar republic",
    "no": "norway|no|norwegian|norge|kingdom of norway|royal norwegian navy", "fr": "france|fr|french|french republic|rep francaise|republique francaise|french navy|vichy france",
    "nl": "netherlands|nl|the netherlands|dutch|holland|royal netherlands navy|nederland", "jp": "japan|jp|japanese|empire of japan|nippon|imperial japanese navy",
    "se": "sweden|se|swedish|sverige|royal swedish navy|kingdom of sweden", "dk": "denmark|dk|danish|danmark|royal danish navy|kingdom of denmark",
    "es": "spain|es|spanish|espana|kingdom of spain|spanish navy", "it": "italy|it|italian|italia|kingdom of italy|regia marina",
    "ca": "canada|ca|canadian|dominion of canada|royal canadian navy", "gr": "greece|gr|greek|hellas|kingdom of greece|hellenic republic",
    "ru": "russia|ru|russian|russian empire|soviet union|ussr|soviet navy|imperial russian navy", "pa": "panama|pa|panamanian", "pt": "portugal|pt|portuguese|portuguese republic",
    "be": "belgium|be|belgian|belgique|belgie", "fi": "finland|fi|finnish|suomi", "au": "australia|au|australian|austrl|commonwealth of australia|royal australian navy",
    "pl": "poland|pl|polish|polska|polish navy", "tr": "turkey|tr|turkish|turkiye|ottoman empire|ottoman navy", "lr": "liberia|lr|liberian", "cl": "chile|cl|chilean|chilean navy",
    "ar": "argentina|ar|argentine|argentinian|argentine navy", "br": "brazil|br|brazilian|brasil|brazilian navy",
}
_COUNTRY = {w: c for c, words in COUNTRIES.items() for w in words.split("|")}


def country(flag: str | None) -> str:
    """A code for the country a flag text means; its plain text if unknown; '' if none is told."""
    if not flag:
        return ""
    t = " ".join(re.sub(r"[^a-z& ]+", "", _MARKS.sub("", fold(flag)).replace("-", " ")).split())
    if t in ("", "unknown", "none", "null", "na", "not known"):
        return ""
    return _COUNTRY.get(t) or _COUNTRY.get(t.removeprefix("the ")) or t
