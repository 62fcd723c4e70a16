"""Variant spellings of names, linked in a metric space.

Stems of names live in a space whose metric is the edit distance, with different years
infinitely apart. Pivots are drawn from the stems, the more of them the fuller a year
is. A stem's home is the cell of its nearest pivot; it is also asked for in each further cell in
which a stem within the radius could be at home, d(y, p) <= d(y, nearest) + 2 r. In a cell
the distances to the pivot exclude most pairs again, letter and letter-pair signatures
(an edit changes at most 2 of the one, 4 of the other) most of the rest, and the true
edit distance decides.

Two rows are the same ship if their stems are near, what else the names say agrees,
and date, country and position do not contradict. A missing value contradicts nothing.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import combinations
from math import comb

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hullmark.llm.names import country, parse
from hullmark.session import release, settle

RADIUS = 3


def letters_of(words: list[str]) -> np.ndarray:
    """Letters as numbers, one row per word; shorter words end in zeros."""
    plain = all(map(str.isascii, words))
    raw = [w.encode("ascii" if plain else "utf-32-le") for w in words]
    kind = np.dtype(np.uint8 if plain else "<u4")
    lengths = np.fromiter(map(len, raw), np.int64, len(raw)) // kind.itemsize
    table = np.zeros((len(raw), max(1, int(lengths.max(initial=1)))), kind)
    table[np.arange(table.shape[1]) < lengths[:, None]] = np.frombuffer(b"".join(raw), kind)
    return table


def edit_distances(a: list[str], b: list[str]) -> np.ndarray:
    """Levenshtein distances of a[i] and b[i], pairs of like lengths together."""
    la, lb = (np.fromiter(map(len, x), np.int64, len(x)) for x in (a, b))
    out, order, at = np.zeros(len(a), np.int64), np.lexsort((la, lb)), 0
    while at < len(order):
        # fewer pairs at once where names are long, so that memory stays bounded
        longest = int(max(la[order[at : at + 16_384]].max(), lb[order[at : at + 16_384]].max(), 1))
        part = order[at : at + max(1, min(16_384, (1 << 22) // longest))]
        at += len(part)
        x, y = (np.ascontiguousarray(letters_of([w[i] for i in part]).T) for w in (a, b))
        n, m = la[part], lb[part]
        kind = np.uint8 if max(len(x), len(y)) < 255 else np.int32
        row = np.repeat(np.arange(len(y) + 1, dtype=kind)[:, None], len(part), 1)
        new, step, differ = np.empty_like(row), np.empty(len(part), kind), np.empty(len(part), bool)
        got = np.where(n == 0, m, 0)
        for i in range(len(x)):
            new[0] = i + 1
            for j in range(len(y)):
                np.add(np.minimum(row[j + 1], new[j], out=step), kind(1), out=step)
                np.add(row[j], np.not_equal(x[i], y[j], out=differ), out=new[j + 1])
                np.minimum(new[j + 1], step, out=new[j + 1])
            row, new = new, row
            ends = np.flatnonzero(n == i + 1)
            got[ends] = row[m[ends], ends]
        out[part] = got
    return out


def _banded(x: np.ndarray, n: np.ndarray, y: np.ndarray, m: np.ndarray, most: int) -> np.ndarray:
    """Levenshtein distances of columns of letters with lengths n and m that differ by ``most`` at most; only the diagonals within ``most`` are filled."""
    far = np.uint8(most + 1)
    y = np.pad(y, ((0, most + 1), (0, 0)))
    row = np.full((2 * most + 3, len(n)), far, np.uint8)  # diagonal o lies at o + most + 1, with a border on either side
    for o in range(most + 1):
        row[o + most + 1] = o
    got = np.where(n == 0, m, most + 1)
    one, differ = np.uint8(1), np.empty(len(n), bool)
    new, step = np.full_like(row, far), np.empty(len(n), np.uint8)
    for i in range(1, int(n.max(initial=0)) + 1):
        for o in range(max(-most, -i), most + 1):
            k = o + most + 1
            if i + o == 0:
                new[k] = min(i, most + 1)
            elif i + o <= len(y):
                np.not_equal(x[i - 1], y[i + o - 1], out=differ)
                np.add(row[k], differ, out=new[k])
                np.add(np.minimum(row[k + 1], new[k - 1], out=step), one, out=step)
                np.minimum(new[k], step, out=new[k])
            else:
                new[k] = far
        np.minimum(new, far, out=new)
        row, new = new, row
        ends = np.flatnonzero(n == i)
        got[ends] = row[m[ends] - i + most + 1, ends]
    return got


def near_distances(words: list[str], i: np.ndarray, j: np.ndarray, most: int) -> np.ndarray:
    """Levenshtein distances of words i and j; anything above ``most`` is told as ``most + 1``. Long words are measured apart from short ones."""
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    n, m = lengths[i], lengths[j]
    out = np.full(len(i), most + 1, np.int64)
    sizes = np.where(np.abs(n - m) <= most, np.ceil(np.log2(np.maximum(np.maximum(n, m), 16))), 0)
    for size in np.unique(sizes[sizes > 0]):
        fit = np.flatnonzero(sizes == size)
        used, where = np.unique(np.concatenate((i[fit], j[fit])), return_inverse=True)
        table = letters_of([words[k] for k in used])
        for at in range(0, len(fit), 16_384):
            part = fit[at : at + 16_384]
            x, y = (np.ascontiguousarray(table[where[s + at : s + at + len(part)]].T) for s in (0, len(fit)))
            out[part] = _banded(x, n[part], y, m[part], most)
    return out


def _signatures(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit marks per word: which letters it has once and twice, and which letter pairs."""
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    one, two = np.zeros(len(words), np.uint64), np.zeros(len(words), np.uint64)
    unit, half = np.uint64(1), np.uint64(32)
    sizes = np.ceil(np.log2(np.maximum(lengths, 16)))
    for size in np.unique(sizes):
        at = np.flatnonzero(sizes == size)
        table = np.ascontiguousarray(letters_of([words[i] for i in at]).T).astype(np.int64)
        long, o, t = lengths[at], one[at], two[at]
        for k in range(len(table)):
            bit = np.where(k < long, unit << ((table[k] - 97) % 32).astype(np.uint64), np.uint64(0))
            o |= np.where(o & bit > 0, bit << half, bit)
            if k:
                t |= np.where(k < long, unit << ((table[k - 1] * 31 + table[k] * 7) % 64).astype(np.uint64), np.uint64(0))
        one[at], two[at] = o, t
    return one, two


def allowed(shorter: np.ndarray) -> np.ndarray:
    """Edits allowed between stems, by the length of the shorter one."""
    return np.where(shorter >= 9, 3, np.where(shorter >= 6, 2, np.where(shorter >= 4, 1, 0)))


def _hits(flags: np.ndarray) -> np.ndarray:
    """Where ``flags`` are set; eight at a time first, as few are."""
    whole = len(flags) & ~7
    eights = np.flatnonzero(flags[:whole].view(np.uint64))
    a, b = np.nonzero(flags[:whole].reshape(-1, 8)[eights])
    return np.concatenate((eights[a] * 8 + b, whole + np.flatnonzero(flags[whole:])))


_STEP = 0x9E3779B97F4A7C15
_BACK = pow(_STEP, -1, 1 << 64)


def _cut_marks(table: np.ndarray, start: np.ndarray, cuts: int) -> Iterator[np.ndarray]:
    """Marks of what is left of words of one length, the columns of ``table``, without ``cuts`` letters, for each choice of these.

    A mark is the sum of the letters times a power of ``_STEP`` for their place, modulo 2^64, so it
    is a sum of one term for each letter cut, which are made ahead.
    """
    size = len(table)
    powers = np.array([pow(_STEP, k + 1, 1 << 64) for k in range(size)], np.uint64)
    sums = np.zeros((size + 1, table.shape[1]), np.uint64)
    np.cumsum((table.astype(np.uint64) + np.uint64(1)) * powers[:, None], 0, out=sums[1:])
    moved = [sums * np.uint64(pow(_BACK, c, 1 << 64)) for c in range(cuts + 1)]  # the sums if c letters before are cut
    last = moved[cuts][size] + start
    terms = [moved[c][:size] - moved[c + 1][1:] for c in range(cuts)]
    for places in combinations(range(size), cuts):
        mark = last
        for c, k in enumerate(places):
            mark = mark + terms[c][k]
        yield mark


def _families(words: list[str], lengths: np.ndarray, start: np.ndarray) -> Iterator[tuple[Callable[[], Iterator[tuple[np.ndarray, np.ndarray]]], int]]:
    """A call that gives words and marks by which some of them meet, and how many marks there are.

    Two words within k edits have a part in common that has k letters less than the longer one.
    Of words with 20 letters or more, within 3 edits, either the first or the last ten letters are
    within 1 edit and share what is left of them without a letter.
    """
    table = lambda at, part=slice(None): np.ascontiguousarray(letters_of([words[i][part] for i in at]).T)
    for low, high, k in ((9, 22, 3), (6, 10, 2), (4, 6, 1)):
        for longer in range(low, high + 1):
            own = [(np.flatnonzero(lengths == size), k - (longer - size)) for size in range(max(low, longer - k), longer + 1)]
            if len(own[-1][0]):
                make = lambda own=own: ((at, mark) for at, cuts in own if len(at) for mark in _cut_marks(table(at), start[at], cuts))
                yield make, sum(len(at) * comb(int(lengths[at[0]]), cuts) for at, cuts in own if len(at))
    long = np.flatnonzero(lengths >= 20)
    for part in (slice(10), slice(-10, None)):
        if len(long):
            yield lambda part=part: ((long, mark) for mark in _cut_marks(table(long, part), start[long], 1)), 10 * len(long)


def _met(words: list[str], lengths: np.ndarray, group: np.ndarray, asks: np.ndarray, member: np.ndarray, likely: Callable[[np.ndarray, np.ndarray], np.ndarray], most: float, at_once: int = 1 << 24) -> tuple[np.ndarray, np.ndarray] | None:
    """Index pairs (asking word, member) of one group that share a mark and are ``likely``; none at all if more than ``most`` share one.

    Marks are sorted with the words' numbers in their low bits. Beyond ``at_once`` of them they
    are made again for each share, so groups should not be much fuller.
    """
    n, found = len(words), np.zeros(0, np.int64)
    bits = np.uint64(max(1, n.bit_length()))
    start = (group.astype(np.uint64) + np.uint64(1)) * np.uint64(0xD1B54A32D192ED03)
    number = np.arange(n, dtype=np.uint64)
    for make, count in _families(words, lengths, start):
        pairs = [found]
        shares = -(-count // at_once)
        for share in range(shares):
            key, to = np.empty(count if shares == 1 else 0, np.uint64), 0
            kept = []
            for at, mark in make():
                own = number[at]
                if shares > 1:
                    fits = np.flatnonzero((mark >> np.uint64(40)) % np.uint64(shares) == share)
                    mark, own = mark[fits], own[fits]
                    kept.append((mark >> bits << bits) | own)
                else:
                    np.bitwise_or(mark >> bits << bits, own, out=key[to : to + len(own)])
                    to += len(own)
            key = np.concatenate(kept) if kept else key
            kept.clear()
            key.sort()
            block = 1 << 20
            step, p = 1, np.concatenate([x + np.flatnonzero((key[x : x + block + 1][1:] ^ key[x : x + block + 1][:-1]) >> bits == 0) for x in range(0, max(1, len(key)), block)])
            while len(p):  # each with the next one of its mark, then with the one after that
                most -= len(p)
                if most < 0:
                    return None
                i, j = ((key[x] & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64) for x in (p, p + step))
                for x, y in ((i, j), (j, i)):
                    fits = np.flatnonzero(asks[x] & member[y] & (x != y))
                    x, y = x[fits], y[fits]
                    fits = likely(x, y)
                    pairs.append(x[fits] * n + y[fits])
                step += 1
                p = p[p + step < len(key)]
                p = p[(key[p + step] ^ key[p]) >> bits == 0]
        found = np.unique(np.concatenate(pairs))
    return np.divmod(found, n)


def near_stems(words: list[str], asks: np.ndarray, to_pivot: np.ndarray, radius: int = RADIUS, member: np.ndarray | None = None, group: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Index pairs (asking word, member, distance) within the radius; all words are members if not told otherwise.

    Where every word asks and is a member, each pair comes once. Marks are compared tile by
    tile, in memory that is used again. Where ``group`` tells which words belong together (of
    others pairs may come or not) and groups are so full that tiles would be much work, words
    look only at those they have a part in common with.
    """
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    one, two = _signatures(words)
    if group is not None and len(words) and radius <= RADIUS:
        held = np.ones(len(words), bool) if member is None else member
        tiles = float((np.bincount(group, asks) * np.bincount(group, held)).sum())
        likely = lambda i, j: (np.bitwise_count(one[i] ^ one[j]) <= 2 * radius) & (np.bitwise_count(two[i] ^ two[j]) <= 4 * radius)
        if tiles > 6000 * len(words) and (met := _met(words, lengths, group, asks, held, likely, tiles / 16)):
            i, j = met
            if member is None and bool(asks.all()):
                i, j = i[i < j], j[i < j]
            keep = np.abs(lengths[i] - lengths[j]) <= radius
            i, j = i[keep], j[keep]
            d = near_distances(words, i, j, radius)
            ok = (d <= np.minimum(allowed(np.minimum(lengths[i], lengths[j])), radius)) & (d > 0)
            return i[ok], j[ok], d[ok]
    order = np.argsort(to_pivot, kind="stable")
    whole = member is None and bool(asks.all())
    homes = order[asks[order]]
    order = order if member is None else order[member[order]]
    sorted_p, one_s, two_s, len_s, one_h = to_pivot[order], one[order], two[order], lengths[order], one[homes]
    high_of, wide = 64, 4096
    marks, bits, near = np.empty(high_of * wide, np.uint64), np.empty(high_of * wide, np.uint8), np.empty(high_of * wide, bool)
    left, right = [], []
    for at in range(0, len(homes), high_of):
        part = homes[at : at + high_of]
        low = at if whole else int(np.searchsorted(sorted_p, to_pivot[part[0]] - radius, "left"))
        high = int(np.searchsorted(sorted_p, to_pivot[part[-1]] + radius, "right"))
        for start in range(low, high, wide):
            w = min(wide, high - start)
            shape, n = (len(part), w), len(part) * w
            m, b, c = marks[:n].reshape(shape), bits[:n].reshape(shape), near[:n].reshape(shape)
            np.bitwise_xor(one_h[at : at + high_of, None], one_s[None, start : start + w], out=m)
            np.bitwise_count(m, out=b)
            np.less_equal(b, 2 * radius, out=c)
            i, j = np.divmod(_hits(near[:n]), w)
            j += start
            if whole:
                later = j > i + at
                i, j = i[later], j[later]
            i = part[i]
            keep = (np.bitwise_count(two[i] ^ two_s[j]) <= 4 * radius) & (np.abs(lengths[i] - len_s[j]) <= radius)
            left.append(i[keep])
            right.append(order[j[keep]])
    none = np.zeros(0, np.int64)
    i, j = np.concatenate(left or [none]), np.concatenate(right or [none])
    other = i != j
    i, j = i[other], j[other]
    d = near_distances(words, i, j, radius)
    ok = (d <= np.minimum(allowed(np.minimum(lengths[i], lengths[j])), radius)) & (d > 0)
    return i[ok], j[ok], d[ok]

def _place(pivots: dict[int, list[str]], radius: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            groups = [(pivots[int(year)], g) for year, g in pdf.groupby("year", sort=False)]
            left = [w for own, g in groups for w in g["stem"] for _ in own]
            right = [p for own, g in groups for _ in range(len(g)) for p in own]
            d_all, at, out = edit_distances(left, right), 0, []
            for own, g in groups:
                stems, asks = g["stem"].tolist(), g["asks"].to_numpy(bool)
                d = d_all[at : at + len(g) * len(own)].reshape(len(g), len(own))
                at += d.size
                best = d.argmin(1)
                # a stem that asks goes to every cell that may hold a near one, others to their own; the fewer
                # edits its length allows, the fewer cells these are
                reach = 2 * np.minimum(allowed(np.fromiter(map(len, stems), np.int64, len(stems))), radius)
                i, c = np.nonzero(d <= np.where(asks, d.min(1) + reach, -1)[:, None])
                rest = np.flatnonzero(~asks)
                i, c = np.concatenate((i, rest)), np.concatenate((c, best[rest]))
                out.append(pd.DataFrame({"year": g["year"].iloc[0], "cell": c, "stem": np.array(stems, object)[i], "asks": asks[i], "held": best[i] == c, "to_pivot": d[i, c]}))
            if out:
                yield pd.concat(out, ignore_index=True).astype({"year": "int32", "cell": "int32", "to_pivot": "int32"})

    return run


def _join_cell(radius: int, once: bool):
    """The join of one cell, or of several years of one cell each."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        words, asks = pdf["stem"].tolist(), pdf["asks"].to_numpy(bool)
        if "held" in pdf:
            held, to_pivot, also = pdf["held"].to_numpy(bool), pdf["to_pivot"].to_numpy(np.int64), pdf["also"].to_numpy(bool)
        else:  # whole years: their pivot is the empty name
            held, to_pivot, also = np.ones(len(words), bool), np.fromiter(map(len, words), np.int64, len(words)), asks
        group, _ = pd.factorize(pdf["year"].astype("int64") * (1 << 31) + (pdf["cell"] if "cell" in pdf else 0))
        apart = int(to_pivot.max(initial=0)) + 2 * radius + 1
        i, j, d = near_stems(words, asks, group * apart + to_pivot, radius, None if once and held.all() else held, group)
        same = group[i] == group[j]
        i, j, d = i[same], j[same], d[same]
        w = np.array(words, object)
        a, b = w[i], w[j]
        if once and held.all() and asks.all():
            a, b = np.where(a < b, a, b), np.where(a < b, b, a)
        elif once:
            keep = (a < b) | ~also[j]  # members that ask themselves find the pair from their side
            i, a, b, d = i[keep], a[keep], b[keep], d[keep]
        return pd.DataFrame({"year": pdf["year"].to_numpy()[i], "a": a, "b": b, "d": d}).astype({"year": "int32", "d": "int32"})

    return run


_CELLS = "year int, cell int, stem string, asks boolean, held boolean, to_pivot int"


def _blocks(placed: DataFrame, most: int, max_cells: int) -> DataFrame:
    """``placed`` with the blocks ``i, j`` of asking stems and of members, so that no task compares more than ``most`` of either.

    Cells within ``most`` are one block. The few beyond are cut by hash: an asking stem goes
    to each block of members, a member to each block of asking stems. The driver holds the
    sizes of ``2 * max_cells`` cells at most; ``most`` grows where there would be more.
    """
    placed = settle(placed.withColumn("also", F.col("asks")))
    most = max(most, -(-placed.count() // max_cells))
    sizes = placed.groupBy("year", "cell").agg(F.count_if("asks").alias("na"), F.count_if("held").alias("nh"))
    full = sizes.where((F.col("na") > most) | (F.col("nh") > most)).collect()
    if not full:
        return placed.select("*", F.lit(0).alias("i"), F.lit(0).alias("j"))
    cuts = placed.sparkSession.createDataFrame([(r["year"], r["cell"], -(-r["na"] // most) or 1, -(-r["nh"] // most) or 1) for r in full], "year int, cell int, na int, nh int")
    at = placed.join(F.broadcast(cuts), ["year", "cell"], "left")
    own = lambda n: F.pmod(F.xxhash64("stem"), n).cast("int")
    block = lambda i, j, asks, held: F.struct(i.alias("i"), j.alias("j"), asks.alias("asks"), held.alias("held"))
    yes, no, zero = F.lit(True), F.lit(False), F.lit(0)
    none = F.slice(F.array(block(zero, zero, no, no)), 1, 0)
    asking = F.when(F.col("asks"), F.transform(F.sequence(zero, F.col("nh") - 1), lambda j: block(own(F.col("na")), j, yes, no))).otherwise(none)
    held = F.when(F.col("held"), F.transform(F.sequence(zero, F.col("na") - 1), lambda i: block(i, own(F.col("nh")), no, yes))).otherwise(none)
    where = F.when(F.col("na").isNull(), F.array(block(zero, zero, F.col("asks"), F.col("held")))).otherwise(F.concat(asking, held))
    return at.select("year", "cell", "stem", "to_pivot", "also", F.explode(where).alias("b")).select("year", "cell", "stem", "to_pivot", "also", "b.*")


def _pieces(stems: DataFrame) -> DataFrame:
    """``stems`` in cells of one group and one piece, at most eight rows each.

    Of two stems within 3 edits (within 2, of eight letters or fewer; within 1, of five or
    fewer), either the first or the last two letters agree, or two letters next to these do, at
    most one place apart: where both ends have an edit, one of the pieces inside has none.
    """
    s, yes, no = F.col("stem"), F.lit(True), F.lit(False)
    piece = lambda kind, at, asks, held: F.struct(F.pmod(F.xxhash64(F.lit(kind), F.substring(s, at, 2)), F.lit((1 << 31) - 1)).cast("int").alias("cell"), asks.alias("asks"), held.alias("held"))
    all_of = [piece("first", 1, F.col("asks"), yes), piece("last", -2, F.col("asks"), yes)]
    for kind, places in (("second", (3, 2, 4)), ("third", (-4, -3, -5))):
        all_of += [piece(kind, at, F.col("asks") if at == places[0] else no, yes) for at in places]
    cut = stems.select("year", "stem", F.length("stem").alias("to_pivot"), F.col("asks").alias("also"), F.explode(F.array(*all_of)).alias("p"))
    return cut.select("year", "stem", "to_pivot", "also", "p.*")


def stem_links(stems: DataFrame, radius: int = RADIUS, per_pivot: int = 2000, max_pivots: int = 4096, most: int = 16_384, once: bool = False, each: int = 4, alone: int = 200_000) -> DataFrame:
    """``year, a, b, d`` of all different stems of one year within the radius.

    ``stems`` has distinct ``year int, stem string, asks boolean``; each stem that asks meets all
    others, so a pair of asking stems comes both ways round, or with ``once`` as a < b only. Any
    number that sets groups infinitely apart can take the place of the year. Groups of more
    than ``per_pivot`` stems have a pivot for each so many, and cells of more than ``most`` are
    joined in blocks. As pivots exclude little, a stem has about as many rows as its group has
    pivots; groups that would have more than ``each`` have none and are one cell up to ``alone``
    stems, beyond that a cell for each piece of two letters. The driver holds ``max_pivots`` counts and twice as many pivots at most,
    for which ``per_pivot`` grows where there are more than so many times as many stems.
    """
    if not hasattr(stems, "_settled_at"):
        stems = settle(stems.select("year", "stem", "asks"))
    n_stems = stems.count()
    full = max(per_pivot, -(-n_stems // max_pivots))
    counts = {int(r["year"]): r["n"] for r in stems.groupBy("year").agg(F.count("*").alias("n")).where(F.col("n") > full).collect()}
    huge = [year for year, n in counts.items() if n > max(alone, each * full)]
    counts = {year: n for year, n in counts.items() if n <= each * full}
    pivots: dict[int, list[str]] = {}
    if counts:
        share = int(min(1.0, 3.0 / full) * (1 << 30))
        drawn = stems.where(F.col("year").isin(list(counts)) & (F.pmod(F.xxhash64("year", "stem"), F.lit(1 << 30)) < share)).select("year", "stem").limit(16 * max_pivots).collect()
        for year, stem in sorted((int(r["year"]), r["stem"]) for r in drawn):
            own = pivots.setdefault(year, [])
            if len(own) < -(-counts[year] // full):
                own.append(stem)
    many = F.col("year").isin(list(pivots)) if pivots else F.lit(False)
    several = F.pmod(F.xxhash64("year"), F.lit(max(1, n_stems // most)))
    cut = F.col("year").isin(huge) if huge else F.lit(False)
    out = stems.where(~many & ~cut).groupBy(several).applyInPandas(_join_cell(radius, once), "year int, a string, b string, d int")
    if pivots:
        cells = _blocks(stems.where(many).mapInPandas(_place(pivots, radius), _CELLS), most, max_pivots)
        out = out.unionByName(cells.groupBy("year", "cell", "i", "j").applyInPandas(_join_cell(radius, once), "year int, a string, b string, d int"))
    if huge:
        found = _pieces(stems.where(cut)).groupBy("year", F.pmod("cell", F.lit(256))).applyInPandas(_join_cell(radius, once), "year int, a string, b string, d int")
        out = out.unionByName(found.distinct())
    return out


def _read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    flags: dict[str, str] = {}
    for pdf in batches:
        names = [parse(x) if isinstance(x, str) else None for x in pdf["name"]]
        keep = np.array([n is not None for n in names], bool)
        if not keep.any():
            continue
        part = pdf[keep].reset_index(drop=True)
        names = [n for n in names if n is not None]
        for f in part["flag"].unique():
            if f not in flags:
                flags[f] = country(f) if isinstance(f, str) else ""
        yield part.assign(
            stem=[n.stem for n in names], given=[n.given for n in names], number=np.array([n.number for n in names], np.int64), prefix=[n.prefix for n in names],
            name_year=np.array([n.year for n in names], np.int64), country=[flags[f] for f in part["flag"]],
        )[["row_no", "written", "stem", "given", "number", "prefix", "name_year", "country", "date", "listed_year", "latitude", "longitude"]]


READ = "row_no long, written long, stem string, given string, number long, prefix string, name_year long, country string, date string, listed_year string, latitude double, longitude double"


def read_rows(rows: DataFrame) -> DataFrame:
    """The named rows of a list of ships with their names taken apart and their years.

    ``written`` is a 64-bit mark of the name's text, to tell whether two are identical. The year is that of the date, else that in the name's brackets or in the title of a
    list of a single year; 0 if none is told.
    """
    dated = F.coalesce(F.col("date"), F.lit("")).rlike(r"^\d{4}")
    listed = F.when(dated, F.lit("")).otherwise(F.regexp_extract(F.coalesce(F.col("source_lists"), F.lit("")), r"\bin (?:\p{L}+ )?(\d{4})(?= \||$)", 1))
    text = lambda c: F.coalesce(F.col(c), F.lit("")).alias(c)
    plain = rows.where(F.coalesce(F.trim("name") != "", F.lit(False))).select(
        F.col("row_no").cast("long"), "name", F.xxhash64("name").alias("written"), text("flag"), text("date"), listed.alias("listed_year"), F.col("latitude").cast("double"), F.col("longitude").cast("double")
    )
    read = plain.mapInPandas(_read, READ)
    year = F.coalesce(F.regexp_extract("date", r"^(\d{4})", 1).try_cast("int"), F.nullif(F.col("name_year"), F.lit(0)).cast("int"), F.col("listed_year").try_cast("int"), F.lit(0))
    return read.withColumn("year", year.cast("int")).drop("listed_year", "name_year")


def haversine_km(la: Column, lo: Column, lb: Column, lp: Column) -> Column:
    h = F.pow(F.sin(F.radians(lb - la) / 2), 2) + F.cos(F.radians(la)) * F.cos(F.radians(lb)) * F.pow(F.sin(F.radians(lp - lo) / 2), 2)
    return 2 * 6371.0 * F.asin(F.least(F.lit(1.0), F.sqrt(F.abs(h))))


def both_placed(a: str, b: str) -> Column:
    """Whether both rows have a position."""
    return F.least(*[(F.col(f"{x}.{c}").isNotNull() & ~F.isnan(f"{x}.{c}")).cast("int") for x in (a, b) for c in ("latitude", "longitude")]) == 1


def position_gap(a: str, b: str) -> Column:
    """Kilometres between two rows' positions, the least over the usual slips of entry
    (a sign lost, latitude and longitude exchanged); null if one is missing."""
    la, lo, lb, lp = F.col(f"{a}.latitude"), F.col(f"{a}.longitude"), F.col(f"{b}.latitude"), F.col(f"{b}.longitude")
    ways = [(la, lo, lb, lp)] + [(la, lo, s * lb, t * lp) for s, t in ((1, -1), (-1, 1), (-1, -1))] + [(la, lo, s * lp, t * lb) for s in (1, -1) for t in (1, -1)]
    return F.when(both_placed(a, b), F.least(*[haversine_km(*w) for w in ways]))


def agree(a: str, b: str) -> Column:
    """Whether what two rows say besides the stem can be of one ship."""
    x, y = (lambda c: F.col(f"{a}.{c}")), (lambda c: F.col(f"{b}.{c}"))
    bare = lambda c: F.rtrim(c, F.lit("."))
    short = (F.length(x("given")) == 1) | (F.length(y("given")) == 1) | F.endswith(x("given"), F.lit(".")) | F.endswith(y("given"), F.lit("."))
    told = (x("given") != "") & (y("given") != "")
    given = (x("given") == y("given")) | (told & short & (F.startswith(bare(x("given")), bare(y("given"))) | F.startswith(bare(y("given")), bare(x("given")))))
    either = lambda c: (x(c) == "") | (y(c) == "") | (x(c) == y(c))
    # told as a difference, so that it is no further key of a join, by which rows would be shuffled once more
    return given & (x("number") - y("number") == 0) & either("prefix") & either("country")


def ship_links(rows: DataFrame, near_km: float = 60.0) -> DataFrame:
    """``row_a, row_b, confidence, differ`` with row_a < row_b of rows that mean one ship, whatever the writing.

    ``differ`` tells whether the two name texts differ (any character counts).

    Wants ``row_no, name, flag, date, latitude, longitude, source_lists``; other columns are
    ignored. Rows without a name, or with a word that only says it is unknown, are in no
    link; repeated rows are linked; an empty table gives none. Rows that tell no year are
    linked to rows at the same place, or else to the rows of one year's ship at most.
    """
    return links_of_read(settle(read_rows(rows)), near_km)


def links_of_read(read: DataFrame, near_km: float = 60.0) -> DataFrame:
    """``ship_links`` of rows that ``read_rows`` gave; they are read several times, so they should be settled."""
    # years and numbers set names infinitely apart; a number has four digits at most
    dated = read.where("year > 0 and stem is not null").withColumn("_group", (F.col("year") * 10_000 + F.col("number")).cast("int"))
    known = settle(dated.groupBy(F.col("_group").alias("year"), "stem").count().withColumn("asks", F.lit(True)))
    near = stem_links(known, once=True)
    same = known.where("count > 1").select("year", F.col("stem").alias("a"), F.col("stem").alias("b"), F.lit(0).alias("d"))
    a, b, p = dated.alias("a"), dated.alias("b"), near.unionByName(same).withColumnRenamed("year", "_group").alias("p")
    day = F.startswith(F.col("a.date"), F.col("b.date")) | F.startswith(F.col("b.date"), F.col("a.date"))
    gap = position_gap("a", "b")
    hit = p.join(a, (F.col("p._group") == F.col("a._group")) & (F.col("p.a") == F.col("a.stem"))).join(
        b, (F.col("p._group") == F.col("b._group")) & (F.col("p.b") == F.col("b.stem"))
    ).where((F.col("p.d") > 0) | (F.col("a.row_no") < F.col("b.row_no"))).where(agree("a", "b") & day & (gap.isNull() | (gap <= near_km)))
    sure = 1 - 0.1 * F.col("p.d") - F.when(both_placed("a", "b"), 0.0).otherwise(0.1) - F.when(F.length("a.date") < 10, 0.1).otherwise(0.0)
    with_year = hit.select(F.least("a.row_no", "b.row_no").alias("row_a"), F.greatest("a.row_no", "b.row_no").alias("row_b"), sure.alias("confidence"), (F.col("a.written") != F.col("b.written")).alias("differ"))

    # rows without a year ask among the rows of all years, with number and country in the place
    # of the year: among those of their country and those without one, or, without a
    # country themselves, among all of their number
    group = lambda c: F.pmod(F.xxhash64(c, "number"), F.lit((1 << 31) - 1)).cast("int").alias("_group")
    held = F.when(F.col("country") == "", "?").otherwise(F.col("country"))
    all_rows = read.withColumn("_g", held).select(*read.columns, group("_g"))
    undated = settle(read.where("year = 0"))
    own = undated.where("country <> ''").select("*", F.explode(F.array("country", F.lit("?"))).alias("_g"))
    every = undated.where("country = ''").join(read.select("number", held.alias("_g")).distinct(), "number").select(*read.columns, "_g")
    loose = own.unionByName(every).select(*read.columns, group("_g"))
    asking = settle(loose.select(F.col("_group").alias("year"), "stem").distinct().withColumn("asks", F.lit(True)))
    members = all_rows.select(F.col("_group").alias("year"), "stem", F.lit(False).alias("asks"))
    stems = asking.unionByName(members).groupBy("year", "stem").agg(F.bool_or("asks").alias("asks"))
    fuzzy = stem_links(stems, per_pivot=16_384).select(F.col("year").alias("_group"), "a", "b", "d")
    exact = asking.select(F.col("year").alias("_group"), F.col("stem").alias("a"), F.col("stem").alias("b"), F.lit(0).alias("d"))
    u, v, p = loose.alias("a"), all_rows.alias("b"), fuzzy.unionByName(exact).alias("p")
    near_enough = gap <= near_km
    met = u.join(p, (F.col("a._group") == F.col("p._group")) & (F.col("a.stem") == F.col("p.a"))).join(v, (F.col("b._group") == F.col("p._group")) & (F.col("b.stem") == F.col("p.b"))).where(
        F.col("a.row_no") != F.col("b.row_no")
    ).where(agree("a", "b") & (gap.isNull() | near_enough)).groupBy(F.col("a.row_no").alias("x"), F.col("b.row_no").alias("y")).agg(
        F.max("b.year").alias("yy"), F.bool_or(both_placed("a", "b")).alias("placed"), F.min("p.d").alias("d"), F.bool_or(F.col("a.written") != F.col("b.written")).alias("differ")
    )
    met = settle(met)
    release(undated, asking)
    # where rows of several years fit, those at the same place win; else none is certain
    years = met.where("yy > 0").groupBy("x").agg(F.countDistinct("yy").alias("n"), F.countDistinct(F.when(F.col("placed"), F.col("yy"))).alias("np"))
    sole = met.join(years, "x", "left").where(F.col("placed") | (F.coalesce("n", F.lit(0)) <= 1))
    sure = F.when(F.col("placed"), 0.8).otherwise(0.6) - 0.1 * F.col("d")
    without = sole.select(F.least("x", "y").alias("row_a"), F.greatest("x", "y").alias("row_b"), sure.alias("confidence"), "differ")
    # two rows without a year may have found each other; no other pair comes twice
    return with_year.unionByName(without.groupBy("row_a", "row_b").agg(F.max("confidence").alias("confidence"), F.bool_or("differ").alias("differ")))


def variant_links(rows: DataFrame) -> DataFrame:
    """The links of ``ship_links`` whose two name texts differ (any character counts)."""
    return ship_links(rows).where("differ").select("row_a", "row_b", "confidence")
