"""Quantities stated in different units, brought to one unit.

A statement is cut into a number, a unit token and at most one smaller part. That runs in
Arrow batches: the patterns need look-behind over some words, for which Java's matcher takes
several times the time of the one used here. Each spelling of a unit, and each way of naming it apart from
the number, is a *source* of values. Conversion follows the sources, not a list of words:

1. rows that describe the same entity are linked by an exact key;
2. for each pair of sources the scale between them is estimated robustly (median of the
   log ratios, with the median absolute deviation), and where no ratio fits, a slope and an offset;
3. a scale is snapped to a known conversion if one lies within ``tolerance``;
4. conversions spread from the base unit through the graph of sources, strongest first.

Where links are many and agree, they decide, whatever the word means elsewhere. Where they are
few, a known spelling keeps the definition of its word, and any other word where a unit is
expected has what the links give it; without ``min_links`` links it gives no value.
The graph has one node per spelling with links, which is all the driver holds.
"""

from __future__ import annotations

import heapq
import math
from typing import NamedTuple

import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Metres in one unit.
METRES = {"metre": 1.0, "foot": 0.3048, "fathom": 1.8288, "yard": 0.9144, "inch": 0.0254, "centimetre": 0.01, "kilometre": 1000.0}

# Spellings of each unit.
SPELLINGS = {
    "metre": ["m", "mtr", "mtrs", "metre", "metres", "meter", "meters", "mètre", "mètres"],
    "foot": ["'", "ft", "feet", "foot", "′", "’"],
    "fathom": ["fm", "fms", "fth", "fths", "fthm", "fthms", "fathom", "fathoms"],
    "yard": ["yd", "yds", "yard", "yards"],
    "inch": ["in", "ins", "inch", "inches", '"', "″", "”"],
    "kilometre": ["km", "kms", "kilometre", "kilometres", "kilometer", "kilometers"],
    "centimetre": ["cm", "cms", "centimetre", "centimetres", "centimeter", "centimeters"],
}
UNIT_OF = {word: unit for unit, words in SPELLINGS.items() for word in words}

# A larger unit and the smaller one that may follow as its part.
_PARTS = {("fathom", "foot"), ("fathom", "inch"), ("yard", "foot"), ("foot", "inch"), ("metre", "centimetre")}

# Number words.
ONES = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen".split()
TENS = "twenty thirty forty fifty sixty seventy eighty ninety".split()

_BY_LENGTH = sorted(UNIT_OF, key=lambda w: (-len(w), w))
_UNIT = "(" + "|".join(_BY_LENGTH) + r")(?![\p{L}])"
_WORDS = sorted(ONES + TENS, key=lambda w: -len(w))
_SPELT = "(?:" + "|".join(_WORDS) + "|hundred|thousand)"
_NUMBER = (
    r"(\d[\d,.]*\d|\d|" + _SPELT + r"(?:(?:[ -]+and)?[ -]+" + _SPELT + r")*)"
    r"( ?[½¼¾⅓⅔⅛⅜⅝⅞]|[ -]\d+[/⁄]\d+)?"
)
_RANGE = r"(?: ?(?:-|–|—|to|or|/) ?\d[\d,.]*(?: ?[½¼¾])?)?"
_SECOND = r"(?:,? ?(?:and )?(\d+(?:[.,]\d+)?) ?" + _UNIT + ")?"
# Where a number may begin.
#: A quantity: 1 number, 2 fraction, 3 unit, 4 second number, 5 second unit.
_START = r"(?<![\p{L}\d])(?<!\d[.,])(?=\d|" + _SPELT + ")"
_QUANTITY = _START + _NUMBER + _RANGE + r"[ -]?" + _UNIT + r"\.?" + _SECOND
_ASIDE = r"(?: ?\([^)]{0,40}\))?"
_AFTER = r" ?(?:of (?:\p{L}+ )?water|deep\b|down\b|(?:below|beneath|under) the (?:surface|sea|water)|depth\b|beneath the|under water|underwater)"
_ROUGHLY = r"(?:(?:about|around|approximately|approx\.?|some|roughly|over|nearly|almost|under|only|just|ca?\.|circa|~|≈|the) ?)*"
#: Words that name the depth ahead of the number.
_BEFORE = (
    r"(?<!\p{L})(?=[dlrsfbhwia])(?:depths?(?<!(?:moulded|molded|hold) depths?)(?: (?:is|was|of|here|at|about|found))*(?: of)?[:,]? ?(?!of hold)"
    r"|(?:lies?|lying|lay|rests?|resting|sits?|sitting|stands?|located|found|remains(?: are)?|bottom|seabed|section(?: is)?|hull(?: is)?|wreck(?: is)?|is|are)"
    r"(?: \p{L}+ly| upright| now)?,? (?:in|at)(?: a depth of)?(?: the)? )"
)
#: Measures of the ship or the sea; a quantity just after one of them is no depth of water.
_OTHER = r"(?:hold|draught|draft|beam|breadth|length|long|moulded|molded|height|tide rose|rose|seas? of|waves? of|swell of|within|light stood|mast|drew|drawing|hole|chain|range|distance)"
_STATED = (
    r"(?:depths?|soundings?)(?! of hold)[^.;\d]{0,40}?(?<![\p{L}'])" + "(" + "|".join(w for w in _BY_LENGTH if len(w) > 1 and w not in ("in", "ins")) + r")(?![\p{L}])"
)


_TIDY = {ord(c): " " for c in "\t\n\r\u00a0\u2002\u2003\u2007\u2009\u200a\u202f\u3000"} | dict.fromkeys(map(ord, "\u200b\u200c\u200d\u2060\ufeff\u00ad"))
_SIGNS = {"½": 0.5, "¼": 0.25, "¾": 0.75, "⅓": 1 / 3, "⅔": 2 / 3, "⅛": 0.125, "⅜": 0.375, "⅝": 0.625, "⅞": 0.875}
_FULL = {w: i + 1 for i, w in enumerate(ONES)} | {w: 10 * (i + 2) for i, w in enumerate(TENS)}
_MARKS = regex.compile(r"\[(?:\d+|[a-z]|note \d+|nb \d+|citation needed)\]")
#: A cheap necessary condition for a quantity in a note.
_MAYBE = regex.compile(r"""[\d½¼¾⅓⅔⅛⅜⅝⅞][ -]?[fmyick'"′’″”]|[a-z][ -](?:fath|feet|foot|ft|met|mtr|yard|cent|inch)""")
_SOME = regex.compile(r"[1-9½¼¾]|" + _SPELT)
_COLUMN = regex.compile(_QUANTITY)
_ALONE = regex.compile(r"^" + _ROUGHLY + r"(\d[\d,.]*)( ?[½¼¾])?" + _RANGE + r" ?(?:deep)? ?(?:\(\?\)|\?)?$")
_DEPTH_AFTER = regex.compile(_START + r"(?<!" + _OTHER + r".{0,14})" + _QUANTITY + _ASIDE + "(?=" + _AFTER + ")")
_NO_DEPTH = r"(?! ?(?:long|wide|broad|high|above|of chain|off\b|from\b|in length|in diameter|apart|away))"
_DEPTH_BEFORE = regex.compile(_BEFORE + _ROUGHLY + r"(?=" + _QUANTITY + _NO_DEPTH + ")")
_UNIT_TOLD = regex.compile(_STATED)
#: The same with any word in the place of the unit; links decide whether it is one.
_ANY = _START + _NUMBER + _RANGE + r"(?:[ -]|(?<=[\d½¼¾⅓⅔⅛⅜⅝⅞]))(\p{L}++)"
_COLUMN_WORD = regex.compile(_ANY)
_WORD_AFTER = regex.compile(r"(?<!" + _OTHER + r".{0,14})" + _ANY + r"\.?" + _ASIDE + "(?=" + _AFTER + ")")
_WORD_BEFORE = regex.compile(_BEFORE + _ROUGHLY + r"(?=" + _ANY + _NO_DEPTH + ")")
_WORD_TOLD = regex.compile(r"(?:depths?|soundings?)(?! of hold)(?: (?:is|are|was|were|here|given|stated|measured|taken|noted))* in (\p{L}++)")


def tidy(text: str | None) -> str:
    """Lower case, plain single blanks, no invisible signs or footnote marks."""
    if not isinstance(text, str) or not text:
        return ""
    t = text.lower()
    if not t.isascii():
        t = t.translate(_TIDY)
    if "[" in t:
        t = _MARKS.sub("", t)
    return " ".join(t.split())


def plain_number(text: str) -> float | None:
    """A number written in digits. A comma before exactly three digits groups thousands,
    any other comma or a point marks decimals."""
    t = regex.sub(r"(?<=\d)[, ](?=\d{3}(?!\d))", "", text).replace(",", ".").rstrip(".")
    try:
        return float(t)
    except ValueError:
        return None


def spelt_number(text: str) -> float:
    """A number in words, below a million."""
    whole = part = 0
    for w in regex.split("[ -]+", text):
        if w == "hundred":
            part = max(part, 1) * 100
        elif w == "thousand":
            whole, part = whole + max(part, 1) * 1000, 0
        else:
            part += _FULL.get(w, 0)
    return float(whole + part)


def number(text: str, fraction: str | None) -> float | None:
    value = plain_number(text) if text[:1].isdigit() else spelt_number(text)
    f = (fraction or "").strip(" -")
    if value is None or not f:
        return value
    over = regex.fullmatch(r"(\d+)[/⁄](\d+)", f)
    return value + (int(over[1]) / int(over[2]) if over and int(over[2]) else _SIGNS.get(f, 0.0))


def _other(found: regex.Match | None) -> tuple[float, str] | None:
    """A number and the word after it."""
    value = number(found[1], found[2]) if found and found[3] not in UNIT_OF else None
    return (value, found[3]) if value and value > 0 else None


def statement(column: str | None, note: str | None) -> tuple[float | None, str | None, float | None, str | None, float | None, str | None] | None:
    """(value, unit token, value of a smaller part, its token, other value, its word) of the depth that is stated, or None.

    The column goes before the note. A number alone gets the token ``note:<unit word>`` if
    the note names a unit for the depth or tells a depth itself, else ``bare``. A word that
    is no known spelling, where a unit is expected, gives the other value: it goes before
    the value if links tell the word's scale, and is nothing if they don't.
    """
    c = tidy(column)
    found = alone = other = None
    if c and _SOME.search(c):
        found = _COLUMN.search(c)
        alone = None if found else _ALONE.match(c)
        other = None if found or alone else _other(_COLUMN_WORD.search(c))
    text = ""
    if not found:
        text = tidy(note)
        if _MAYBE.search(text):
            found = _DEPTH_AFTER.search(text) or _DEPTH_BEFORE.search(text)
    if alone and (value := number(alone[1], alone[2])):
        told = _UNIT_TOLD.search(text)
        unit = told[1] if told else found[3] if found else None
        named = None if unit else _WORD_TOLD.search(text)
        return value, f"note:{unit}" if unit else "bare", None, None, *((value, f"note:{named[1]}") if named else (None, None))
    if not found and not other and _SOME.search(text):
        other = _other(_WORD_AFTER.search(text) or _WORD_BEFORE.search(text))
    value = number(found[1], found[2]) if found else None
    if not value or value <= 0:
        return (None, None, None, None, *other) if other else None
    if found[4] and (UNIT_OF[found[3]], UNIT_OF[found[5]]) in _PARTS:
        return value, found[3], plain_number(found[4]), found[5], *(other or (None, None))
    return value, found[3], None, None, *(other or (None, None))


def _statements(column: pd.Series, note: pd.Series) -> pd.DataFrame:
    told = [statement(c, n) or (None,) * 6 for c, n in zip(column, note, strict=True)]
    out = pd.DataFrame(told, columns=["value", "token", "value2", "token2", "other", "word"])
    return out.astype({"value": "float64", "value2": "float64", "other": "float64", "token": object, "token2": object, "word": object})


def stated_depths(df: DataFrame, column: str = "depth_m", note: str = "note") -> DataFrame:
    """``df`` with ``_q`` (value, token, value2, token2, other, word), null where no depth is stated; see ``statement``."""
    # not deterministic only in name: else a filter on the result would run the search twice
    read = F.pandas_udf(_statements, "value double, token string, value2 double, token2 string, other double, word string").asNondeterministic()
    out = df.withColumn("_q", read(F.col(column).cast("string"), F.col(note)))
    return out.select(*df.columns, F.when((F.col("_q.value") > 0) | (F.col("_q.other") > 0), F.col("_q")).alias("_q"))


def unit_of(token: str) -> str | None:
    """The unit a source's word stands for; the base unit for bare numbers."""
    return "metre" if token == "bare" else UNIT_OF.get(token.removeprefix("note:"))


def sources(df: DataFrame, entity: str) -> DataFrame:
    """``_e, _v, _t``: entity, value and token of the statements of ``df._q`` that have one part.

    A number alone whose note names an unknown unit speaks for that word only.
    """
    q = F.col("_q")
    named = F.coalesce(F.startswith(q["word"], F.lit("note:")), F.lit(False))
    own = F.when(q["token"].isNotNull() & q["token2"].isNull() & ~named, F.struct(q["value"].alias("v"), q["token"].alias("t")))
    other = F.when(q["word"].isNotNull(), F.struct(q["other"].alias("v"), q["word"].alias("t")))
    each = df.where(q.isNotNull()).select(F.col(entity).alias("_e"), F.explode(F.array_compact(F.array(own, other))).alias("_s"))
    return each.select("_e", F.col("_s.v").alias("_v"), F.col("_s.t").alias("_t"))


def pair_scales(df: DataFrame, entity: str, value: str, token: str, least: int = 1) -> DataFrame:
    """For each two tokens with ``least`` links: links, median log ratio b/a and its deviation; and the log of the
    slope (the ratio of the middle halves), with the offset that a known conversion next to it leaves, the offset's spread and the level of b.

    Only entities told by exactly one value per token count, so that a hot entity key
    adds at most one link per pair of tokens.
    """
    each = df.where(F.col(entity).isNotNull() & (F.col(value) > 0)).groupBy(entity, token).agg(
        F.min(value).alias("lo"), F.max(value).alias("hi")
    ).where(F.col("lo") == F.col("hi"))
    told = each.groupBy(entity).agg(F.sort_array(F.collect_list(F.struct(F.col(token).alias("t"), F.col("lo").alias("v")))).alias("all")).where(F.size("all") > 1)
    a = told.select("all", F.posexplode("all").alias("i", "a"))
    links = a.select(F.col("a.t").alias("token_a"), F.col("a.v").alias("v_a"), F.explode(F.slice("all", F.col("i") + 2, F.size("all"))).alias("b")).select(
        "token_a", "v_a", F.col("b.t").alias("token_b"), F.col("b.v").alias("v_b")
    ).withColumn("r", F.log(F.col("v_b") / F.col("v_a")))
    quarter = lambda c: F.percentile_approx(c, F.array(F.lit(0.25), F.lit(0.75)), 1000)
    wide = lambda c: F.col(c)[1] - F.col(c)[0]
    scale = links.groupBy("token_a", "token_b").agg(
        F.count("*").alias("links"), F.percentile_approx("r", 0.5, 1000).alias("log_scale"), quarter("v_a").alias("qa"), quarter("v_b").alias("qb")
    ).where(F.col("links") >= least).select("token_a", "token_b", "links", "log_scale", F.when((wide("qa") > 0) & (wide("qb") > 0), F.log(wide("qb") / wide("qa"))).alias("log_slope"))
    known = F.array(*[F.lit(k) for k in sorted({math.log(x / y) for x in METRES.values() for y in METRES.values()})])
    scale = scale.withColumn("log_known", F.array_min(F.transform(known, lambda k: F.struct(F.abs(k - F.col("log_slope")).alias("d"), k.alias("k"))))["k"])
    near = links.join(F.broadcast(scale), ["token_a", "token_b"])  # one row per pair of spellings
    rest = F.col("v_b") - F.exp("log_known") * F.col("v_a")
    told = near.groupBy("token_a", "token_b").agg(
        F.first("links").alias("links"), F.first("log_scale").alias("log_scale"), F.percentile_approx(F.abs(F.col("r") - F.col("log_scale")), 0.5, 1000).alias("deviation"),
        F.first("log_slope").alias("log_slope"), F.percentile_approx(rest, 0.5, 1000).alias("offset"), (quarter(rest)).alias("_q"), F.percentile_approx("v_b", 0.5, 1000).alias("level"),
    )
    return told.select("token_a", "token_b", "links", "log_scale", "deviation", "log_slope", "offset", ((F.col("_q")[1] - F.col("_q")[0]) / 2).alias("offset_spread"), "level")


def snap(log_scale: float, tolerance: float = 0.06) -> float | None:
    """The log of the known conversion (ratio of two units) next to a scale, if near."""
    best = min((math.log(x / y) for x in METRES.values() for y in METRES.values()), key=lambda k: abs(k - log_scale))
    return best if abs(best - log_scale) <= tolerance else None


class Edge(NamedTuple):
    """What links tell of two sources: b = exp(log_scale) * a, or with an offset b = exp(log_slope) * a + offset."""

    a: str
    b: str
    links: int
    log_scale: float
    deviation: float
    log_slope: float | None = None
    offset: float | None = None
    offset_spread: float | None = None
    level: float | None = None

    def line(self, max_deviation: float, sure_links: int) -> tuple[float, float] | None:
        """Factor and offset from a to b, snapped to a known conversion; None if the links do not agree on one.

        An offset is told only by ``sure_links`` links that it fits several times closer than a bare
        ratio does, and where it stands out from its own spread.
        """
        if self.links >= sure_links and None not in (self.log_slope, self.offset, self.offset_spread, self.level):
            known, left = snap(self.log_slope), self.offset_spread / max(abs(self.level), 1e-9)
            if known is not None and left <= min(max_deviation, self.deviation / 3) and abs(self.offset) > max(3 * self.offset_spread, 0.02 * abs(self.level)):
                return math.exp(known), self.offset
        known = snap(self.log_scale) if self.deviation <= max_deviation else None
        return None if known is None else (math.exp(known), 0.0)


def spread(edges: list[tuple], tokens: set[str], base: str = "m", min_links: int = 5, max_deviation: float = 0.05, sure_links: int = 20) -> dict[str, tuple[float, float, str]]:
    """Of each token the metres in one, the metres to add, and how they came about.

    ``edges`` have the fields of ``Edge``. Those with few links or that agree on no known conversion
    are left out. The rest spread from ``base``, most links first (a widest-path search). Where a way
    of ``sure_links`` links at every step reaches a token, the links decide (``linked``), against
    the word's definition too (``redefined``); where fewer do, they decide for words without a
    definition and are a check for the others, whose definition stands (``defined`` without
    links, ``contradicted`` where they say otherwise).
    """
    near: dict[str, list[tuple[int, str, float, float]]] = {}
    for e in (Edge(*x) for x in edges):
        line = e.line(max_deviation, sure_links) if e.links >= min_links else None
        if line:
            k, c = line
            near.setdefault(e.a, []).append((e.links, e.b, k, c))
            near.setdefault(e.b, []).append((e.links, e.a, 1 / k, -c / k))
    found: dict[str, tuple[float, float, int]] = {}
    queue = [(-(1 << 62), base, 1.0, 0.0)]
    while queue:
        width, token, scale, shift = heapq.heappop(queue)
        if token in found:
            continue
        found[token] = (scale, shift, -width)
        for links, other, k, c in near.get(token, []):
            if other not in found:
                # metres = scale * a + shift, and a = (b - c) / k
                heapq.heappush(queue, (max(width, -links), other, scale / k, shift - scale * c / k))
    out = {}
    for t in tokens:
        unit = unit_of(t)
        own = METRES[unit] if unit is not None else None
        if t not in found:
            if own is not None:
                out[t] = (own, 0.0, "defined")
            continue
        scale, shift, width = found[t]
        scale = min(METRES.values(), key=lambda x: abs(math.log(x / scale)))
        if own is None or (scale == own and (shift == 0.0 or width >= sure_links)):
            out[t] = (scale, shift, "linked")
        elif width >= sure_links:
            out[t] = (scale, shift, "redefined")
        else:
            out[t] = (own, 0.0, "contradicted")
    return out


def token_scales(df: DataFrame, entity: str, min_links: int = 5) -> dict[str, tuple[float, float, str]]:
    """Scales and offsets of all tokens of ``df._q``, by links between rows of one ``entity``; words without a definition or links have none."""
    found = pair_scales(sources(df, entity), "_e", "_v", "_t", min_links)
    edges = [tuple(r) for r in found.select("token_a", "token_b", "links", "log_scale", "deviation", "log_slope", "offset", "offset_spread", "level").collect()]
    seen = {r[0] for r in df.where(F.col("_q").isNotNull()).select(F.explode(F.array("_q.token", "_q.token2")).alias("t")).distinct().collect()} - {None}
    return spread(edges, seen | {t for e in edges for t in e[:2]}, min_links=min_links)


def depths_in_metres(df: DataFrame, entity: Column, column: str = "depth_m", note: str = "note") -> DataFrame:
    """``df`` with ``depth_value_m`` (double) and ``depth_scale_from``, rows without a stated depth left out.

    Null and empty columns, texts of any length, repeated rows and an empty table are
    all defined: no statement, no row. Zero is no depth.
    """
    from hullmark.session import settle

    kept = [c for c in df.columns]
    read = stated_depths(df.withColumn("_entity", entity), column, note).where(F.col("_q").isNotNull())
    read = settle(read.select(*kept, "_entity", "_q"))
    scales = token_scales(read, "_entity")
    if not scales:
        return read.select(*kept, F.lit(None).cast("double").alias("depth_value_m"), F.lit(None).cast("string").alias("depth_scale_from")).where(F.lit(False))
    per = lambda i: F.create_map(*[x for t, told in scales.items() for x in (F.lit(t), F.lit(told[i]))])
    metres, shift, how = per(0), per(1), per(2)
    q = F.col("_q")
    word, token, part = (F.coalesce(q[c], F.lit("")) for c in ("word", "token", "token2"))
    at = lambda v, t: v * F.try_element_at(metres, t) + F.try_element_at(shift, t)
    value = at(q["value"], token) + F.coalesce(q["value2"] * F.try_element_at(metres, part), F.lit(0.0))
    value = F.coalesce(at(q["other"], word), value)
    told = F.coalesce(F.try_element_at(how, word), F.try_element_at(how, token))
    return read.select(*kept, value.alias("depth_value_m"), told.alias("depth_scale_from")).where("depth_value_m > 0")
