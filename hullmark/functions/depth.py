"""Depths in metres out of free text.

A text is cut at its quantities, and each quantity is judged by what stands around it.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from hullmark.functions.text import let

# Units of depth and metres in one.
TO_METRES = {"m": 1.0, "metre": 1.0, "metres": 1.0, "meter": 1.0, "meters": 1.0, "ft": 0.3048, "foot": 0.3048, "feet": 0.3048, "fathom": 1.8288, "fathoms": 1.8288, "fm": 1.8288, "fms": 1.8288}
# Words that may soften a number, and those of a ship's own measures.
ROUGHLY = ("about", "approximately", "around", "some", "roughly", "over", "nearly", "~", "c.")
OWN_MEASURES = ("hold", "draught", "draft")
# What stands right after a depth, beside water; and how far back a ship's measure is looked for.
DOWN = ("deep", "down", "below the surface", "beneath the surface")
LOOK_BACK = 25

_ASIDE = r"^(?: ?\([^)]{0,30}\))? "
_WATER = _ASIDE + r"of (?:\w+ )?water"
_DOWN = _ASIDE + "(?:" + "|".join(DOWN) + ")"
_NAMED = r"(?<!hold )(?<!moulded )depth of (?:(?:" + "|".join(w.replace(".", r"\.") for w in ROUGHLY) + ") ?)?$"


def _quantity(compat: bool) -> str:
    """A number, perhaps the end of its range, and a unit. ``compat`` reads four digits without a comma from the second on."""
    number = (r"\d{1,3}" if compat else r"\d+") + r"(?:,\d{3})*(?:\.\d+)?"
    units = "|".join(sorted(TO_METRES, key=len, reverse=True))
    return ("" if compat else r"(?<![\d.,])") + f"({number})(?: ?(?:-|–|to) ?{number})? ?-? ?({units})\\b"


def extract_depth(text: Column, compat: bool = False) -> Column:
    """Metres, one place, of the best told depth; null if there is none above 0 and below 11,000.

    A depth of water goes before one named as such, that before one that lies deep or down, and
    that before "at so much depth"; of equals the first counts. Words of a ship's own measures
    shortly before rule a quantity out.
    """
    quantity = _quantity(compat)
    value = F.create_map(*[x for u, m in TO_METRES.items() for x in (F.lit(u), F.lit(m))])
    clear = lambda c: ~F.right(c, F.lit(LOOK_BACK)).rlike("|".join(OWN_MEASURES))

    def judged(t: Column, i: Column) -> Column:
        """Order of the kind of depth that the i-th quantity (from 1) is, its place and metres; null if it is none."""
        ahead = F.array_join(F.zip_with(F.slice(t["between"], 1, i), F.concat(F.array(F.lit("")), F.slice(t["found"], 1, i - 1)), lambda x, y: F.concat(y, x)), "")
        return let(F.struct(ahead.alias("ahead"), F.substring(t["text"], F.length(ahead) + F.length(F.element_at(t["found"], i)) + 1, F.length(t["text"])).alias("rest"), F.regexp_replace(ahead, _NAMED, "").alias("named")), lambda c: ranked(t, i, c["ahead"], c["rest"], c["named"]))

    def ranked(t: Column, i: Column, ahead: Column, rest: Column, named: Column) -> Column:
        kind = (
            F.when(rest.rlike(_WATER) & clear(ahead), 1).when((named != ahead) & clear(named), 2).when(rest.rlike(_DOWN) & clear(ahead), 3)
            .when(ahead.rlike(r"\bat $") & rest.rlike(_ASIDE + "depth") & clear(F.regexp_replace(ahead, "at $", "")), 4)
        )
        metres = F.replace(F.element_at(t["number"], i), F.lit(","), F.lit("")).try_cast("double") * F.element_at(value, F.element_at(t["unit"], i))
        return F.when(kind.isNotNull() & (metres > 0) & (metres < 11_000), F.struct(kind.alias("kind"), i.alias("i"), F.round(metres, 1).alias("metres")))

    def best(t: Column) -> Column:
        each = F.transform(F.filter(F.sequence(F.lit(0), F.size(t["found"])), lambda i: i > 0), lambda i: judged(t, i))
        return F.array_min(F.array_compact(each))["metres"]

    t = F.regexp_replace(F.lower(text), r"(?U)\s+", " ")
    parts = lambda t: F.struct(t.alias("text"), F.split(t, quantity).alias("between"), *[F.regexp_extract_all(t, F.lit(quantity), F.lit(g)).alias(n) for g, n in enumerate(("found", "number", "unit"))])
    return F.when(t.rlike(quantity), let(let(t, parts), best))


def column_number(text: Column) -> Column:
    """The first number of a depth column in metres; feet if it says so."""
    v = F.replace(F.regexp_extract(text, r"([\d.,]+)", 1), F.lit(","), F.lit("")).try_cast("double")
    feet = F.arrays_overlap(F.split(F.lower(text), "[^a-z0-9]+"), F.array(*map(F.lit, ("ft", "feet", "foot"))))
    return F.round(F.when(feet, v * TO_METRES["ft"]).otherwise(v), 1)


def row_depth(column: Column, note: Column, compat: bool = False) -> Column:
    """The depth column first, read as a depth or a bare number, then the note."""
    return F.coalesce(extract_depth(F.concat(column, F.lit(" deep")), compat), column_number(column), extract_depth(note, compat))
