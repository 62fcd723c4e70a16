"""Coded chart attributes and their labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Code lists of the public S-57 standard, label n has code n.
CODE_LISTS = {
    "CATWRK": ["non-dangerous wreck", "dangerous wreck", "distributed remains of wreck", "wreck showing mast/masts", "wreck showing any portion of hull or superstructure"],
    "CATOBS": ["snag/stump", "wellhead", "diffuser", "crib", "fish haven", "foul area", "foul ground", "ice boom", "ground tackle", "boom"],
    "WATLEV": ["partly submerged at high water", "always dry", "always under water/submerged", "covers and uncovers", "awash", "subject to inundation or flooding", "floating"],
    "QUASOU": [
        "depth known", "depth unknown", "doubtful sounding", "unreliable sounding", "no bottom found at value shown", "least depth known", "least depth unknown, safe clearance at value shown",
        "value reported (not surveyed)", "value reported (not confirmed)", "maintained depth", "not regularly maintained",
    ],
    "TECSOU": [
        "found by echo-sounder", "found by side scan sonar", "found by multi-beam", "found by diver", "found by lead-line", "swept by wire-drag", "found by laser", "swept by vertical acoustic system",
        "found by electromagnetic sensor", "photogrammetry", "satellite imagery", "found by levelling", "swept by side-scan sonar", "computer generated",
    ],
    "EXPSOU": ["within range of surrounding depth", "shoaler than surrounding depth", "deeper than surrounding depth"],
    "VERDAT": [
        "Mean low water springs", "Mean lower low water springs", "Mean sea level", "Lowest low water", "Mean low water", "Lowest low water springs", "Approximate mean low water springs",
        "Indian spring low water", "Low water springs", "Approximate lowest astronomical tide", "Nearly lowest low water", "Mean lower low water", "Low water", "Approximate mean low water",
        "Approximate mean lower low water", "Mean high water", "Mean high water springs", "High water", "Approximate mean sea level", "High water springs", "Mean higher high water",
        "Equinoctial spring low water", "Lowest astronomical tide", "Local datum", "International Great Lakes Datum 1985", "Mean water level", "Lower low water large tide",
        "Higher high water large tide", "Nearly highest high water", "Highest astronomical tide",
    ],
}


def decode(value: Column, attribute: str, compat: bool = False) -> Column:
    """Labels of a code, a list of codes, or a label cut off at its end; '' for null and ''.

    Parts are joined by ``; ``. An unknown code or text stays as it is. A text that is a
    label as a whole stays that label; ``compat`` takes the first label that begins with
    it instead, and cuts labels at their own commas.
    """
    labels = CODE_LISTS[attribute]
    known = F.array(*[F.lit(x) for x in labels])
    text = F.coalesce(value.cast("string"), F.lit(""))

    def one(part: Column) -> Column:
        number = part.try_cast("double").try_cast("int")
        by_code = F.when((number >= 1) & (number <= len(labels)), F.element_at(known, F.when((number >= 1) & (number <= len(labels)), number).otherwise(1))).otherwise(part)
        begun = F.filter(known, lambda x: (part != "") & F.startswith(x, part))
        by_text = F.coalesce(F.try_element_at(begun, F.lit(1)), part)
        if not compat:
            by_text = F.when(F.array_contains(known, part), part).otherwise(by_text)
        return F.when(number.isNotNull(), by_code).otherwise(by_text)

    parts = F.transform(F.split(text, ","), lambda p: one(F.trim(p)))
    out = F.array_join(parts, "; ")
    if not compat:
        out = F.when(F.array_contains(known, F.trim(text)), F.trim(text)).otherwise(out)
    return F.when(text == "", F.lit("")).otherwise(out)


def code_table() -> list[tuple[str, int, str]]:
    return [(a, i + 1, label) for a, labels in CODE_LISTS.items() for i, label in enumerate(labels)]
