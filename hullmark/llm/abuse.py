"""Scoring texts for abusive, hateful and sexual language.

A linear softmax over averaged embeddings of subwords (hashed letter runs, words and
word pairs), trained jointly in numpy: a misspelt word shares most of its letter runs,
and so most of its vector, with the right one. As the last layer is linear, the trained
embeddings are folded with it into one small table, and scoring is a gather and running
sums over all letters of a batch at once. A text is scored by its worst passage:
each sentence or line, and within longer ones each window of some words.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CLASSES = ("none", "abuse", "hate", "sexual")
BUCKETS = 1 << 17
RUNS = (3, 4, 5)
FEW = 9  # features of a single word of four letters

# Passages of our own, beside the labelled ones: what such language tends to look like.
OWN = {
    "abuse": """shut up you idiot|you are an idiot|what an idiot you are|you are a complete moron|you stupid fool, nobody likes you|you are a liar and a coward|you worthless piece of trash|you filthy pig, get out of here
go to hell you bastard|you are a disgrace and a cheat|i hope you die|i hope you drown|i will kill you|i will find you and break your legs|we know where you live|watch your back, we are coming for you
you had better sleep with one eye open|one day i will shoot you|he is a stinking drunk and a thief|that man is a brainless fool|what a pathetic loser you are|you make me sick, you ugly cow|you fucking idiot|fuck off, all of you
he is a lying son of a bitch|you are nothing but scum|drop dead, you moron|your whole crew are useless imbeciles|i will burn down your boat|you will pay for this with your blood|kill yourself, nobody will miss you|stupid cow
tu es un idiot et un lâche|ta gueule, pauvre con|va te faire foutre|espèce d'imbécile|je vais te tuer|sale menteur, va crever|tu n'es qu'une ordure|tu es une merde et tout le monde le sait|va au diable, sale chien
du bist ein Idiot|du dummes Schwein|halt dein Maul, du Trottel|ich bringe dich um|verpiss dich, du Arschloch|du verdammter Lügner, verrecke doch|du bist der letzte Dreck|fahr zur Hölle, du Hurensohn
eres un idiota y un cobarde|vete a la mierda|cállate, imbécil|te voy a matar|hijo de puta, ojalá te mueras|eres un cabrón y un mentiroso|eres basura, nadie te quiere
du er en idiot|hold kjeft, din dumme idiot|jeg skal drepe deg|dra til helvete, din drittsekk|du er en løgner og en feiging|din jævla taper|håper du drukner, ditt svin""",
    "hate": """those people are animals|they are all criminals by birth|that race is inferior and always was|send them all back where they came from|they should be wiped out|the foreigners are a plague on this coast|no foreigners wanted here, they are filth
women are too stupid to command a ship|a woman on board is good for one thing only|cripples should be put down|the disabled are a burden and should be left to die|all of them are thieves, it is in their blood|they are not human beings, they are rats
immigrants are vermin|keep our blood pure|the only good one is a dead one|let them drown, there are too many of them anyway|people like that do not deserve to live|these savages cannot be taught anything|their kind should not breed
ces gens sont des animaux|les étrangers sont des parasites|qu'on les renvoie tous chez eux|cette race est inférieure|il faut tous les noyer|les femmes sont trop bêtes pour naviguer|ils n'ont pas leur place parmi les hommes
diese Leute sind Tiere|die Ausländer sind Parasiten|man sollte sie alle ersäufen|diese Rasse ist minderwertig|Frauen sind zu dumm für ein Schiff|sie sind Ratten und gehören ausgerottet|die Krüppel soll man verrecken lassen
esa gente son animales|los extranjeros son parásitos|hay que echarlos a todos|esa raza es inferior|las mujeres son demasiado tontas para navegar|son escoria y hay que eliminarlos
de folkene er dyr|utlendinger er parasitter|send dem alle hjem|den rasen er mindreverdig|kvinner er for dumme til å seile|de er rotter og bør utryddes""",
    "sexual": """she undressed and they made love in the bunk|he touched her breasts and kissed her naked body|they had sex on the deck|free porn videos, click here|hot naked girls waiting for you|send me nude pictures|she moaned while he was inside her
he slid his hand up her skirt and between her legs|she pulled him on top of her, naked|i want to sleep with you tonight, naked|he took her from behind|horny and looking for a hookup tonight|she sucked him off below deck|they fucked all night|he came inside her|adult xxx videos
ils ont baisé toute la nuit|elle était nue sur lui et gémissait|filles nues, vidéos porno gratuites|il lui caressa les seins nus et les cuisses|viens dans mon lit, je bande déjà
sie fickten die ganze Nacht|nackte Mädchen, Pornos kostenlos|er griff ihr zwischen die Beine|sie stöhnte nackt auf ihm|komm in meine Koje, ich bin geil
follaron en la cubierta|chicas desnudas, porno gratis|le tocó los pechos desnudos y los muslos|ella gemía desnuda encima de él
de knullet hele natten|nakne jenter, gratis porno|han tok henne på brystene og mellom lårene|hun stønnet naken over ham""",
    "none": """the crew were rescued by the lifeboat|the cook swore when the stove went out|he was fined for swearing at the pilot|damn this weather|the bloody engine failed again|hell of a storm last night|the captain was killed when the mast fell|three men drowned and two were badly hurt
the ship's dog and a bitch with pups were saved|the cock was left open|a pair of tits sang on the rail|the ass carried the stores|the crippled ship drifted ashore|women and children first|the foreign crew were landed safely|he was murdered by pirates|the prisoners were hanged at the yard
the hull was stripped bare|the naked eye could see the light|the screw turned slowly|the sexton rang the bell|she went down with all hands|she went down by the head off the point|she lay on her side with her bottom exposed|the master came on deck|the girl figurehead was recovered
Die Mannschaft wurde gerettet|Der Hund des Kapitäns überlebte|verdammtes Wetter heute|les femmes et les enfants furent sauvés|le capitaine jura|maldito viento|la tripulación se salvó|mannskapet ble reddet|fy for et vær
the forum does not allow insults|please be polite, no abuse here|i was an idiot and forgot my torch|silly me, wrong year|my stupid compass broke|this ugly old wreck|the rats left the hold|vermin had eaten the bread|the parasite worms had eaten the planks""",
}

# Digits and signs that stand for letters, and letters of other scripts that look Latin.
LOOKS_LIKE = str.maketrans(
    "013457@$!|" + "аеорсухіѕјԁһкмтвнΑΒΕΖΗΙΚΜΝΟΡΤΥΧαορνι",
    "oieastasii" + "aeopcyxisjdhkmtbhabezhikmnoptyxaopvi",
)
_HIGH = {k: v for k, v in LOOKS_LIKE.items() if k > 0x36F}
_UNSEEN = dict.fromkeys([0xAD, 0x200B, 0x200C, 0x200D, 0x2060, 0xFEFF])
_SPREAD = re.compile(r"(?<!\w)(?:[^\W\d_][ .\-_*]){2,}[^\W\d_](?!\w)")
_LEET = re.compile(r"(?=[\w@$!|]*[^\W\d_])(?=[\w@$!|]*[0-9@$!|])[\w@$|!]{3,}")
_MIXED = re.compile(r"[^\W\d_].*[0-9@$!|].*[^\W\d_]|^[0-9@$][^\W\d_]{2}")
_LONG = re.compile(r"(.)\1{2,}")
_HINT = re.compile(r"[A-Za-z_][0-9@$!|]|[0-9@$!|][A-Za-z_]")
_SIGNS = re.compile(r"(?<!\w)\*|\*(?!\w)|[^\w*\n]|_")
_SPLIT = re.compile(r"[\n\r]+|(?<=[.!?…])[\"”»')\]]*\s+|\s*\|\s*|(?<=[;])\s+")


def _unleet(m: re.Match) -> str:
    word = m.group()
    return word if word.strip("!|").isdigit() or not _MIXED.search(word) else word.translate(LOOKS_LIKE)


def _plain_lines(texts: list[str], simple: bool) -> list[str]:
    """Lines made plain; ``simple`` ones have ASCII letters only and no sign beside a letter that could stand for one."""
    text = "\n".join(texts)
    if not simple and not text.isascii():
        text = unicodedata.normalize("NFKC", text).translate(_UNSEEN)
    text = _SPREAD.sub(lambda m: re.sub(r"[ .\-_*]", "", m.group()), text)
    if not simple:
        text = _LEET.sub(_unleet, text).casefold()
        if not text.isascii():
            text = unicodedata.normalize("NFKD", text.translate(_HIGH))
            text = text.translate({ord(c): None for c in set(text) if unicodedata.combining(c)})
    text = _SIGNS.sub(" ", _LONG.sub(r"\1", text.lower() if simple else text))
    return [" ".join(t.split()) for t in text.split("\n")]


def plain_all(texts: list[str]) -> list[str]:
    """``plain`` of many texts, as one text of a line each."""
    lines = [t.replace("\n", " ") for t in texts]
    hard = [not t.isascii() or _HINT.search(t) is not None for t in lines]
    simple = iter(_plain_lines([t for t, h in zip(lines, hard, strict=True) if not h], True))
    rest = iter(_plain_lines([t for t, h in zip(lines, hard, strict=True) if h], False))
    return [next(rest if h else simple) for h in hard]


def plain(text: str) -> str:
    """Lower-case letters and single blanks, with disguises undone; other signs become blanks, a star inside a word stays."""
    return plain_all([text])[0]


def passages(text: str) -> list[str]:
    return [p for p in plain_all([x for x in _SPLIT.split(text) if x]) if p]


class Bag:
    """Letters of many passages in one array, with what is needed to sum over any of them."""

    def __init__(self, parts: list[str]):
        raw = [b" " + re.sub(r"\d+", "0", p).encode("utf-8") + b" " for p in parts]
        self.lengths = np.fromiter(map(len, raw), np.int64, len(raw))
        self.starts = np.concatenate(([0], np.cumsum(self.lengths)[:-1])) if raw else np.zeros(0, np.int64)
        self.letters = np.frombuffer(b"".join(raw), np.uint8).astype(np.uint64)
        self.owner = np.repeat(np.arange(len(raw)), self.lengths)

    def features(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Arrays of (position of the first letter, bucket), one for each kind of feature."""
        x, n = self.letters, len(self.letters)
        mix = np.uint64(0x9E3779B97F4A7C15)
        with np.errstate(over="ignore"):
            for size in RUNS:
                if n < size:
                    continue
                h = np.full(n - size + 1, np.uint64(size))
                for k in range(size):
                    h = h * np.uint64(1099511628211) + x[k : n - size + 1 + k]
                whole = self.owner[: n - size + 1] == self.owner[size - 1 :]
                h *= mix
                yield np.flatnonzero(whole), (h[whole] >> np.uint64(47)).astype(np.int64)
            space = x == 32
            begins = np.flatnonzero(space[:-1] & ~space[1:]) + 1 if n else np.zeros(0, np.int64)
            ends = np.flatnonzero(~space[:-1] & space[1:]) + 1 if n else np.zeros(0, np.int64)
            if len(begins):
                powers = np.cumprod(np.full(n, np.uint64(6364136223846793005)))
                running = np.concatenate((np.zeros(1, np.uint64), np.cumsum((x + np.uint64(1)) * powers)))
                # a word's letters weighted by their place in the batch; divided by the first weight by an odd inverse
                inverse = np.cumprod(np.full(n, np.uint64(pow(6364136223846793005, -1, 1 << 64))))
                word = (running[ends] - running[begins]) * inverse[begins]
                word = word * mix + np.uint64(77)
                word *= mix
                yield begins, (word >> np.uint64(47)).astype(np.int64)
                pair = (word[:-1] * np.uint64(31) + word[1:]) * mix
                near = self.owner[begins[:-1]] == self.owner[begins[1:]]
                yield begins[:-1][near], (pair[near] >> np.uint64(47)).astype(np.int64)


def _feature_rows(parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """All features of passages, in order of passage: (owner, bucket)."""
    bag = Bag(parts)
    own, bucket = zip(*[(bag.owner[p], b) for p, b in bag.features()], strict=True)
    own, bucket = np.concatenate(own), np.concatenate(bucket)
    order = np.argsort(own, kind="stable")
    return own[order], bucket[order]


def train(parts: list[str], labels: np.ndarray, weights: np.ndarray, dim: int = 12, epochs: int = 14, rate: float = 0.25, seed: int = 3) -> np.ndarray:
    """The folded table (buckets x classes): embeddings and output layer trained jointly, adaptively scaled steps on shuffled batches."""
    rng = np.random.default_rng(seed)
    own, bucket = _feature_rows(parts)
    bounds = np.searchsorted(own, np.arange(len(parts) + 1))
    used, local = np.unique(bucket, return_inverse=True)
    emb = rng.normal(0, 1 / dim, (len(used), dim))
    out = np.zeros((dim, len(CLASSES)))
    seen_e, seen_o = np.full(len(used), 1e-8), 1e-8
    one = np.eye(len(CLASSES))[labels]
    for _ in range(epochs):
        order = rng.permutation(len(parts))
        for at in range(0, len(order), 64):
            batch = order[at : at + 64]
            rows = np.concatenate([local[bounds[i] : bounds[i + 1]] for i in batch])
            counts = bounds[batch + 1] - bounds[batch]
            where = np.repeat(np.arange(len(batch)), counts)
            mean = np.add.reduceat(emb[rows], np.concatenate(([0], np.cumsum(counts)[:-1])), axis=0) / counts[:, None]
            z = mean @ out
            z -= z.max(1, keepdims=True)
            p = np.exp(z)
            p /= p.sum(1, keepdims=True)
            g = (p - one[batch]) * weights[batch, None] / len(batch)
            g_mean = g @ out.T
            g_out = mean.T @ g
            u, back = np.unique(rows, return_inverse=True)
            per = (g_mean / counts[:, None])[where]
            g_emb = np.stack([np.bincount(back, per[:, k], len(u)) for k in range(dim)], 1)
            seen_e[u] += (g_emb**2).mean(1)
            seen_o += (g_out**2).mean()
            emb[u] -= rate * g_emb / np.sqrt(seen_e[u])[:, None]
            out -= rate * g_out / np.sqrt(seen_o)
    table = np.zeros((BUCKETS, len(CLASSES)), np.float32)
    table[used] = emb @ out
    return table


def _bad(z: np.ndarray, unknown: np.ndarray) -> np.ndarray:
    """Probability of any class but the first. Features never trained on speak for the first class."""
    z = z.copy()
    z[:, 0] += 3 * unknown**2
    z -= z.max(1, keepdims=True)
    e = np.exp(z)
    return 1 - e[:, 0] / e.sum(1)


def score_passages(table: np.ndarray, parts: list[str], window: int = 10, step: int = 3) -> np.ndarray:
    """Per passage the worst of the whole and, if it is longer, of its windows of words."""
    if not parts:
        return np.zeros(0)
    bag, k = Bag(parts), len(CLASSES)
    n = len(bag.letters)
    # per bucket its part of each class, one, and whether it was never trained on
    wide = np.column_stack((table, np.ones(len(table), np.float32), ~np.any(table != 0, axis=1))).astype(np.float32)
    sums = np.zeros((n + 1, k + 2))
    for at, bucket in bag.features():
        sums[at + 1] += wide[bucket]  # of one kind, only one feature begins at a letter
    np.cumsum(sums, 0, out=sums)
    ends = bag.starts + bag.lengths

    def between(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        part = sums[b] - sums[a]
        n_features = part[:, k]
        per = part / np.maximum(n_features, 1)[:, None]
        # a few letters alone prove little, but a whole word is one
        return _bad(per[:, :k], per[:, k + 1]) * np.minimum(1.0, n_features / FEW)

    worst = between(bag.starts, ends)
    space = np.flatnonzero(bag.letters == 32)
    first = np.searchsorted(space, bag.starts)  # the blank each passage begins with
    words = np.searchsorted(space, ends - 1) - first
    long = np.flatnonzero(words > window + 2)
    if len(long):
        turns = -(-(words[long] - window) // step) + 1
        begins = np.concatenate(([0], np.cumsum(turns)[:-1]))
        at = (np.arange(turns.sum()) - np.repeat(begins, turns)) * step
        at = np.minimum(at, np.repeat(words[long] - window, turns)) + np.repeat(first[long], turns)
        worst[long] = np.maximum(worst[long], np.maximum.reduceat(between(space[at], space[at + window]), begins))
    return worst


def fit(labelled: list[tuple[str, str]], common: list[tuple[str, float]], folds: int = 5, seed: int = 3, boilerplate: float = 0.001) -> tuple[np.ndarray, dict]:
    """Train on labelled passages, our own, and the ``common`` passages of the corpus (with the share of documents that have each).

    A passage that stands in more than a share ``boilerplate`` of all documents is a form, and
    taken for harmless whatever the labels say; so are the other common ones, but for those the first
    model finds bad. Labelled passages whose label the other folds contradict clearly, or the corpus as
    a form, are left out as mistakes. Also gives the held-out figures.
    """
    texts = plain_all([t for t, _ in labelled])
    shares: dict[str, float] = {}
    for p, share in zip(plain_all([t for t, _ in common]), (x for _, x in common), strict=True):
        if p:
            shares[p] = shares.get(p, 0.0) + share
    keep = [i for i, t in enumerate(texts) if t]
    texts, y = [texts[i] for i in keep], np.array([CLASSES.index(labelled[i][1]) for i in keep], int)
    formal = np.array([shares.get(t, 0.0) > boilerplate for t in texts], bool) & (y > 0)
    own = [(plain(t), CLASSES.index(c)) for c, block in OWN.items() for line in block.split("\n") for t in line.split("|")]
    forms, others = [p for p, x in shares.items() if x > boilerplate], [p for p, x in shares.items() if x <= boilerplate]
    rng = np.random.default_rng(seed)
    fold = rng.integers(0, folds, len(texts))
    held = np.zeros(len(texts))

    def learn(base: list[str], labels: np.ndarray, harmless: list[str], turn: int) -> np.ndarray:
        parts = base + [t for t, _ in own] + harmless
        ys = np.concatenate([labels, [c for _, c in own], np.zeros(len(harmless), int)]).astype(int)
        w = np.concatenate([np.ones(len(labels)), np.full(len(own), 0.7), np.full(len(harmless), 0.5)])
        return train(parts, ys, w, seed=turn)

    for k in range(folds):
        rest = np.flatnonzero((fold != k) & ~formal)
        table = learn([texts[i] for i in rest], y[rest], forms, k)
        held[fold == k] = score_passages(table, [texts[i] for i in np.flatnonzero(fold == k)])
    truth = y > 0
    wrong = formal | (truth & (held < 0.15)) | (~truth & (held > 0.97))
    good = np.flatnonzero(~wrong)
    base, labels = [texts[i] for i in good], y[good]
    first = learn(base, labels, forms, 11)
    harmless = forms + [p for p, s in zip(others, score_passages(first, others), strict=True) if s < 0.5]
    table = learn(base, labels, harmless, 12)
    said = held > 0.5
    told = {"passages": len(texts), "held_out_precision": float((said & truth).sum() / max(1, said.sum())), "held_out_recall": float((said & truth).sum() / max(1, truth.sum())), "taken_for_mistakes": int(wrong.sum()), "forms": len(forms), "common": len(harmless)}
    return table, told


def _score(table: np.ndarray):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for at in range(0, len(pdf), 512):
                part = pdf.iloc[at : at + 512]
                cut = [[x for x in _SPLIT.split(t) if x] if isinstance(t, str) else [] for t in part["_text"]]
                unique = list(dict.fromkeys(x for c in cut for x in c))
                forms = plain_all(unique) if unique else []
                scores, group, size = {}, [], 0
                for p in dict.fromkeys(forms):  # some letters at a time, so that memory stays bounded
                    group.append(p)
                    size += len(p)
                    if size > 400_000:
                        scores |= zip(group, score_passages(table, group), strict=True)
                        group, size = [], 0
                scores |= zip(group, score_passages(table, group), strict=True)
                of = {x: float(scores[p]) if p else 0.0 for x, p in zip(unique, forms, strict=True)}
                yield pd.DataFrame({"_key": part["_key"].to_numpy(), "score": [max((of[x] for x in c), default=0.0) for c in cut]})

    return run


def common_passages(documents: DataFrame, text: str = "text", most: int = 4000) -> list[tuple[str, float]]:
    """Passages of the ``most`` forms that stand in the most documents, counted over all of them, each with its own share of the documents.

    Passages are of one form if they differ in words with a capital and in numbers only. Of a form its most
    frequent passage is given, and the first and last in text order.
    """
    pieces = F.array_distinct(F.filter(F.split(F.col(text), r"[\n\r]+|(?<=[.!?…;])\s+|\s*\|\s*"), lambda x: (F.length(x) > 0) & (F.length(x) < 400)))
    counts = documents.where(F.col(text).isNotNull()).select(F.explode(pieces).alias("p")).groupBy("p").agg(F.count("*").alias("n"))
    form = F.regexp_replace(F.regexp_replace("p", r"\p{Lu}[\p{L}'’.-]*", "*"), r"\p{N}+", "0")
    forms = counts.groupBy(form.alias("form")).agg(F.sum("n").alias("all"), F.max("n").alias("n"), F.max_by("p", F.struct("n", "p")).alias("p"), F.min("p").alias("low"), F.max("p").alias("high")).where("all > 1")
    total, out = max(1, documents.count()), {}
    for r in forms.orderBy(F.desc("all"), "form").limit(most).collect():
        out |= {r["low"]: 0.0, r["high"]: 0.0}
        out[r["p"]] = r["n"] / total
    return list(out.items())


_MODELS: dict[int, tuple[np.ndarray, dict]] = {}


def trained(documents: DataFrame, labels: DataFrame, text: str = "text", most_common: int = 4000, most_labels: int = 20_000) -> tuple[np.ndarray, dict]:
    """A model of at most ``most_labels`` labelled rows, drawn by hash, and the ``most_common`` passages that recur most in all documents.

    Rows without a text or with another label teach nothing. The model of the same passages is trained once in a session.
    """
    rows = labels.where(F.col("text").isNotNull() & F.col("label").isin(*CLASSES)).orderBy(F.xxhash64("item_id"), "item_id").limit(most_labels).select("text", "label").collect()
    taught = sorted((r["text"], r["label"]) for r in rows)
    common = sorted(common_passages(documents, text, most_common))
    key = hash((tuple(taught), tuple(common)))
    if key not in _MODELS:
        _MODELS.clear()
        _MODELS[key] = fit(taught, common)
    return _MODELS[key]


def scored(documents: DataFrame, table: np.ndarray, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, score`` for every row: the probability that its worst passage is abusive, hateful or sexual.

    Null, empty and blank texts score 0. Texts are read whole; repeated rows each have their row.
    """
    kind = documents.schema[key].dataType.simpleString()
    rows = documents.select(F.col(key).alias("_key"), F.col(text).alias("_text"))
    return rows.mapInPandas(_score(table), f"_key {kind}, score double").select(F.col("_key").alias(key), "score")


def source_rates(scores: DataFrame, source: Column, threshold: float) -> DataFrame:
    """Documents, documents over the threshold, their rate and the mean score of each source; null for a missing source."""
    return scores.groupBy(source.alias("source")).agg(
        F.count("*").alias("documents"), F.count_if(F.col("score") >= threshold).alias("flagged"),
        F.avg((F.col("score") >= threshold).cast("double")).alias("rate"), F.avg("score").alias("mean_score"),
    )
