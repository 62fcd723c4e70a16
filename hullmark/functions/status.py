"""What a note says became of a ship."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Words for a ship that was saved, and for one that was lost.
SAVED = [
    "refloated", "re-floated", "was salvaged", "were salvaged", "later salvaged", "subsequently salvaged", "salvaged and", "raised and", "was raised", "later raised", "repaired", "returned to service",
    "put back into service", "towed (?:in|into|to)", "taken in tow", "got off", "gotten off", "brought into", "assisted into", "put into", "was rescued and", "righted", "refitted", "rebuilt", "recommissioned",
]
LOST = [
    "sank", "sunk", "foundered", "wrecked", "was lost", "were lost", "total loss", "lost with all hands", "scuttled", "broke up", "broken up by", "destroyed", "went down", "torpedoed",
    "burnt to the waterline", "burned to the waterline", "wreck lies", "the wreck", "scrapped in situ",
]


def _first(note: Column, words: list[str]) -> Column:
    """Where the first of the words begins, 0 if none does."""
    return F.regexp_instr(note, F.lit(r"(?i)\b(?:" + "|".join(words) + r")\b"))


def classify(note: Column) -> Column:
    """``wreck``, ``refloated`` or ``unknown``. With both kinds of words the one whose first mention comes later decides."""
    text = F.coalesce(note, F.lit(""))
    lost, saved = _first(text, LOST), _first(text, SAVED)
    return F.when((lost > 0) & ((saved == 0) | (saved < lost)), F.lit("wreck")).when(saved > 0, F.lit("refloated")).otherwise(F.lit("unknown"))
