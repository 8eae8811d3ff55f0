"""Toxicity with noisy-channel deobfuscation.

Restoring. A word that mixes letters with look-alike characters, repeats a letter three times or more, or is spelled out
("1d10t", "st000pid", "i-d-i-o-t") spans a lattice: each character offers the letters it may stand for, a repeated
character also offers fewer copies, a mark between letters or at an end also offers nothing, one of several stars offers
any letter. Only exclamation marks at the end are punctuation, where nothing but a word is before them, and stars behind a
mark that is no letter ("word.***"). The Viterbi path under a channel cost and a character trigram model is the restored
word. The trigram counts are taken from all words of the corpus.

What counts as a disguised word is set by parameters: at most ``OTHERS_PER_LETTER`` other characters per letter, or, if all
of them are stars, ``STARS_PER_LETTER``; several stars stand for as many letters in tokens of at most ``CENSORED_LENGTH``
characters, and for one letter or nothing in longer ones. Other tokens are numbers, rules and the like, and are no words.

Scoring. Features of a text are its restored words and their prefixes, each at three levels (one, two, four or more
different words), and those of toxic use, at most ``MAX_FEATURES``, are chosen and weighed by a logistic regression. It is
fitted on about ``FIT_ROWS`` labelled rows, chosen by a hash of the id; everything else, trigram counts and scores, covers all rows.
Labels only enter from rows whose crc32(doc_id) mod 4 is not 2. Language, source and id are no features.

Null and empty texts get the score of a text without features. A null doc_id is not held out and has no label; when a
label row repeats an id, the larger label counts. Without labels of both kinds every score is the base rate (0 without
any label). Repeated rows score alike. Other columns are kept; ``score``, ``predicted`` and ``held_out`` are replaced.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from helixframe.llm.common import save

FIT_ROWS = 20_000
MAX_FEATURES = 4_000
MIN_TOXIC = 3
PREFIXES = (3, 4, 5, 6, 7)
LEVELS = (1, 2, 4)
CUT = 0.3
MEMO_ENTRIES, MEMO_LENGTH = 100_000, 64  # a memo lives as long as its task and keeps no longer words
SLICE = 128  # rows of the fit whose features a task holds at a time
OTHERS_PER_LETTER, STARS_PER_LETTER = 2, 3

# Letters that a character may stand for.
LOOKS_LIKE = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "il",
    "|": "il", "+": "t", "(": "c", "<": "c", "€": "e", "£": "l", "¡": "i", "*": "aeiou", "#": "h", "%": "x",
}
SEPARATORS = ".-_*·'`~,:;/\\ "
LETTERS = "abcdefghijklmnopqrstuvwxyz" + "".join(chr(c) for c in range(0xDF, 0x180) if chr(c).isalpha() and chr(c) == chr(c).lower())
KNOWN = frozenset(LETTERS)
SUBSTITUTE, DROP, SQUEEZE = 1.5, 0.7, 0.4  # channel costs in nats
EDGE = "^"
# A star of several in a word of at most this length stands for any letter.
WILD, ANY, CENSORED_LENGTH = "\0", "abcdefghijklmnopqrstuvwxyz", 24

STRIP = "".join(c for c in map(chr, range(33, 127)) if not c.isalnum() and c not in "@$!|+(<*") + "«»„“”…"
SPELLED = re.compile(r"(?<!\S)(?:[^\s\d] ){2,}[^\s\d](?!\S)")
MARKS = re.compile(r"(?<=[^\W\d_]{3})([|+(<*$@])\1{2,}\Z")
TRAILING_STARS = re.compile(r"(?<=[^\w*])\*{2,}\Z")
TRIPLE = re.compile(r"(.)\1\1")


class CharacterModel:
    """Letter trigrams with interpolation."""

    def __init__(self, counts: dict[str, int]):
        self.three = counts
        self.two, self.one, self.pair, self.total = defaultdict(int), defaultdict(int), defaultdict(int), 0
        for g, n in counts.items():
            self.two[g[:2]] += n
            self.pair[g[1:]] += n
            self.one[g[2]] += n
            self.total += n
        self.start = defaultdict(int)
        for g, n in self.pair.items():
            self.start[g[0]] += n
        self.memo: dict[str, float] = {}

    def cost(self, gram: str) -> float:
        """Negative log probability of the third letter after the first two."""
        got = self.memo.get(gram)
        if got is None:
            if len(self.memo) > MEMO_ENTRIES:
                self.memo.clear()
            p1 = (self.one.get(gram[2], 0) + 0.5) / (self.total + 100)
            p2 = (self.pair.get(gram[1:], 0) + 5 * p1) / (self.start.get(gram[1], 0) + 5)
            p3 = (self.three.get(gram, 0) + 5 * p2) / (self.two.get(gram[:2], 0) + 5)
            got = self.memo[gram] = -math.log(p3)
        return got


def count_trigrams(words: Counter) -> Counter:
    """Trigram counts of weighted words of the alphabet, word edges marked; punctuation around them is left out."""
    kept, times = [], []
    for token, n in words.items():
        word = token.strip(STRIP)
        if word and KNOWN.issuperset(word):
            kept.append(word)
            times.append(n)
    if not kept:
        return Counter()
    # All words in a row, each as edge, edge, word, edge; a trigram is one number, windows across two words weigh nothing.
    row = np.frombuffer((EDGE * 2 + (EDGE * 3).join(kept) + EDGE).encode("utf-32-le"), dtype="<u4")
    place = np.zeros(row.max() + 1, dtype=np.int64)
    used = np.flatnonzero(np.bincount(row))
    place[used] = np.arange(len(used))
    codes, size = place[row], len(used)
    lengths = np.array([len(w) for w in kept]) + 3
    weights = np.repeat(np.array(times, dtype=np.float64), lengths)[:-2]
    ends = np.cumsum(lengths)[:-1]
    weights[ends - 1] = weights[ends - 2] = 0
    sums = np.bincount((codes[:-2] * size + codes[1:-1]) * size + codes[2:], weights=weights)
    letters = [chr(c) for c in used]
    at = np.flatnonzero(sums)
    names = (letters[g // size**2] + letters[g // size % size] + letters[g % size] for g in at.tolist())
    return Counter(dict(zip(names, sums[at].astype(np.int64).tolist(), strict=True)))


def plain(token: str) -> bool:
    """Whether a token needs no restoring."""
    return token.isalpha() and not TRIPLE.search(token)


def obscured(token: str) -> bool:
    """Whether letters are mixed with other characters, or repeat."""
    letters = sum(c.isalpha() for c in token)
    others = len(token) - letters
    censored = others == token.count("*") and others <= STARS_PER_LETTER * letters
    return letters > 0 and (others <= OTHERS_PER_LETTER * letters or censored) and (others > 0 or bool(TRIPLE.search(token)))


def lattice(token: str) -> list[list[tuple[str, float]]]:
    """Per position of a token what it may stand for: letters and channel cost."""
    # Runs of one character become one position with a choice of copies.
    runs = [(m[0][0], len(m[0])) for m in re.finditer(r"(.)\1*", token, re.S)]
    if len(token) <= CENSORED_LENGTH and "**" in token:
        # Several stars stand for as many letters.
        runs = [x for c, n in runs for x in ([(WILD, 1)] * n if c == "*" and n > 1 else [(c, n)])]
    positions = []
    for i, (c, n) in enumerate(runs):
        offers: list[tuple[str, float]] = []
        stands = [(c, 0.0)] if c in KNOWN or c.isalpha() else []  # a letter of another script stands for itself
        stands += [(x, SUBSTITUTE) for x in (ANY if c == WILD else LOOKS_LIKE.get(c, ""))]
        for x, cost in stands:
            offers.append((x * n, cost)) if n <= 2 else None
            if n >= 2:
                offers.append((x, cost + (SQUEEZE if n > 2 else 2 * SQUEEZE)))
            if n > 2:
                offers.append((x * 2, cost + 2 * SQUEEZE))
        if not c.isalpha() and (c == WILD or c in SEPARATORS or c in LOOKS_LIKE and i in (0, len(runs) - 1) or not stands):
            offers.append(("", DROP * min(n, 2)))
        positions.append(offers or [("", DROP)])
    return positions


def restore(token: str, model: CharacterModel) -> str:
    """Most likely word behind a token."""
    paths: dict[str, tuple[float, str]] = {EDGE + EDGE: (0.0, "")}
    for offers in lattice(token):
        ahead: dict[str, tuple[float, str]] = {}
        for state, (cost, word) in paths.items():
            for letters, extra in offers:
                total, at = cost + extra, state
                for x in letters:
                    total += model.cost(at + x)
                    at = at[1] + x
                if at not in ahead or total < ahead[at][0]:
                    ahead[at] = (total, word + letters)
        paths = ahead
    return min((cost + model.cost(state + EDGE), word) for state, (cost, word) in paths.items())[1]


class Reader:
    """Restored words of texts; remembers recent tokens."""

    def __init__(self, model: CharacterModel):
        self.model, self.memo = model, {}

    def word(self, token: str) -> str:
        core = token.strip(STRIP)
        if plain(core):
            return core
        core = TRAILING_STARS.sub("", core).strip(STRIP)
        if plain(core):
            return core
        if not obscured(core):
            return ""
        # Exclamation marks at the end are rather punctuation, as are three or more of a mark after a longer word.
        tail = MARKS.sub("", core).rstrip("!")
        return tail if plain(tail) else restore(core, self.model)

    def words(self, text: str | None) -> set[str]:
        """Different restored words of a text, with what spelled-out letters join to."""
        low = (text or "").lower()
        tokens = set(low.split())
        memo = self.memo
        if len(memo) > MEMO_ENTRIES:
            memo.clear()
        found, fresh = set(), tokens.difference(memo)
        for token in fresh:
            word = self.word(token)
            found.add(word)
            if len(token) <= MEMO_LENGTH:
                memo[token] = word
        found.update(map(memo.__getitem__, tokens - fresh))
        for m in SPELLED.finditer(low):
            letters = m[0].replace(" ", "")
            found.add(letters if plain(letters) else restore(letters, self.model))
        found.discard("")
        return found


def word_features(word: str) -> list[str]:
    return ["=" + word] + [word[:k] for k in PREFIXES if len(word) >= k]


def levelled(counts: Counter) -> Iterator[tuple[str, int]]:
    for feature, n in counts.items():
        for level in LEVELS if feature[0] != "=" else LEVELS[:1]:
            if n >= level:
                yield feature, level


def slices(batches: Iterator[pa.RecordBatch], n: int = SLICE) -> Iterator[pa.RecordBatch]:
    """The rows in parts of ``n``, so that a task holds the Python objects of few rows at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, n):
            yield batch.slice(at, n)


def feature_batches(batches: Iterator[pa.RecordBatch], reader: Reader, wanted: frozenset | None) -> Iterator[pa.RecordBatch]:
    """Levelled features of each text beside its label; only the wanted ones, if given."""
    # A wanted feature is one string, however many rows have it.
    names = None if wanted is None else {(f.rsplit("\t", 1)[0], int(f.rsplit("\t", 1)[1])): f for f in wanted}
    bases = None if names is None else {f for f, _ in names}
    memo: dict[str, tuple[str, ...]] = {}
    for part in slices(batches):
        out = []
        for text in part.column("text").to_pylist():
            tally: Counter = Counter()
            for w in reader.words(text):
                told = memo.get(w)
                if told is None:
                    told = tuple(f for f in word_features(w) if bases is None or f in bases)
                    if bases is not None and len(memo) < MEMO_ENTRIES and len(w) <= MEMO_LENGTH:
                        memo[w] = told
                if told:
                    tally.update(told)
            out.append([f"{f}\t{n}" for f, n in levelled(tally)] if names is None else [names[x] for x in levelled(tally) if x in names])
        yield pa.RecordBatch.from_arrays([part.column("toxic"), pa.array(out, pa.list_(pa.string()))], ["toxic", "features"])


def held_out(doc_id: Column) -> Column:
    """Rows whose labels are never learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def character_model(texts: DataFrame) -> CharacterModel:
    """Trigram counts of all words of the corpus. The alphabet is fixed, so there are at most |alphabet|^3 of them."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams: Counter = Counter()
        words: Counter = Counter()
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                words.update(" ".join(x for x in batch.column(0).slice(at, 256).to_pylist() if x).lower().split())
                if len(words) > 100_000:
                    grams.update(count_trigrams(words))
                    words.clear()
        grams.update(count_trigrams(words))
        yield pa.RecordBatch.from_arrays([pa.array(list(grams), pa.string()), pa.array(list(grams.values()), pa.int64())], ["gram", "n"])

    counted = texts.select("text").mapInArrow(rows, "gram string, n long").groupBy("gram").agg(F.sum("n").alias("n"))
    return CharacterModel({r["gram"]: r["n"] for r in counted.collect()})


class Scorer:
    """Logistic regression over levelled features."""

    def __init__(self, counts: dict[str, int], features: list[tuple[str, int]], weights: np.ndarray, bias: float):
        self.counts, self.features, self.weights, self.bias = counts, features, weights, bias


class Scoring:
    """A scorer at work in one task; its memos end with the task."""

    def __init__(self, scorer: Scorer):
        self.weights, self.bias = scorer.weights, scorer.bias
        self.reader = Reader(CharacterModel(scorer.counts))
        self.index = {f: i for i, f in enumerate(scorer.features)}
        self.bases = {f for f, _ in scorer.features}
        self.memo: dict[str, tuple[str, ...]] = {}

    def active(self, words: set[str]) -> list[int]:
        """Features that the words of a text have."""
        memo = self.memo
        if len(memo) > MEMO_ENTRIES:
            memo.clear()
        counts: Counter = Counter()
        for w in words:
            told = memo.get(w)
            if told is None:
                told = tuple(f for f in word_features(w) if f in self.bases)
                if len(w) <= MEMO_LENGTH:
                    memo[w] = told
            if told:
                counts.update(told)
        return [self.index[f] for f in levelled(counts) if f in self.index]

    def score(self, text: str | None) -> float:
        z = self.bias + sum(self.weights[i] for i in self.active(self.reader.words(text)))
        return float(1 / (1 + math.exp(-max(-60.0, min(60.0, z)))))


def fit_weights(rows: list[np.ndarray], labels: np.ndarray, n_features: int, ridge: float = 1.0, steps: int = 400) -> tuple[np.ndarray, float]:
    """Ridge logistic regression by accelerated gradient steps."""
    sizes = np.array([len(r) for r in rows])
    columns = np.concatenate(rows) if len(rows) else np.zeros(0, dtype=int)
    owner = np.repeat(np.arange(len(rows)), sizes)
    weights, bias = np.zeros(n_features), 0.0
    rate = labels.mean()
    bias = math.log(rate / (1 - rate))
    ahead_w, ahead_b, momentum = weights.copy(), bias, 1.0
    # Step from a bound of the curvature: a quarter of the largest row norm times the rows of the most common feature.
    column_sums = np.bincount(columns, weights=(sizes[owner] + 1.0), minlength=n_features) if len(columns) else np.zeros(n_features)
    step = 1 / (0.25 * max(column_sums.max(initial=0.0), float((sizes + 1).sum())) + ridge)
    for _ in range(steps):
        z = np.bincount(owner, weights=ahead_w[columns], minlength=len(rows)) + ahead_b
        gap = 1 / (1 + np.exp(-np.clip(z, -60, 60))) - labels
        new_w = ahead_w - step * (np.bincount(columns, weights=gap[owner], minlength=n_features) + ridge * ahead_w)
        new_b = ahead_b - step * gap.sum()
        after = (1 + math.sqrt(1 + 4 * momentum**2)) / 2
        ahead_w = new_w + (momentum - 1) / after * (new_w - weights)
        ahead_b = new_b + (momentum - 1) / after * (new_b - bias)
        weights, bias, momentum = new_w, new_b, after
    return weights, bias


def fit(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> Scorer:
    """Learn a scorer from the labelled rows that are not held out."""
    counts = character_model(docs).three
    known = (
        labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out(F.col("doc_id")))
        .groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    )
    share = min(1.0, fit_rows / max(1, known.count()))
    # The sample is a hash share of the labels, so its size does not grow with the input.
    chosen = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < int(share * (1 << 30)))
    if chosen.count() <= 2 * fit_rows:
        chosen = F.broadcast(chosen)  # ids and labels, bounded by fit_rows
    sample = save(docs.select("doc_id", "text").join(chosen, "doc_id").select("text", "toxic"), "sample")
    shared = docs.sparkSession.sparkContext.broadcast(counts)  # bounded: alphabet^3 counts

    def extract(rows: DataFrame, wanted: frozenset | None = None) -> DataFrame:
        """Features of each row; only the wanted ones, if given."""

        def features_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            return feature_batches(batches, Reader(CharacterModel(shared.value)), wanted)

        return rows.select("toxic", "text").mapInArrow(features_of, "toxic int, features array<string>")

    # Toxic rows first: only what several of them have is then counted in the others. Both are bounded by fit_rows.
    toxic = extract(sample.where("toxic = 1")).select(F.explode("features").alias("feature"))
    spam = toxic.groupBy("feature").agg(F.count(F.lit(1)).alias("bad")).where(F.col("bad") >= MIN_TOXIC)
    spam = save(spam, "features")
    rows = save(extract(sample, frozenset(r["feature"] for r in spam.select("feature").collect())), "features")
    clean = rows.where("toxic = 0").select(F.explode("features").alias("feature")).groupBy("feature").agg(F.count(F.lit(1)).alias("good"))
    n_good, n_bad = (rows.where(F.col("toxic") == x).count() for x in (0, 1))
    if not n_bad or not n_good:
        rate = (n_bad + 0.0) / max(1, n_bad + n_good)
        return Scorer(counts, [], np.zeros(0), math.log(max(rate, 1e-12) / max(1 - rate, 1e-12)))
    table = spam.join(clean, "feature", "left").select(
        "feature", "bad", F.coalesce("good", F.lit(0)).alias("good"))
    # Likelihood ratio of use in toxic and in clean texts, where toxic use is the higher.
    bad, good = F.col("bad") / n_bad, F.col("good") / n_good
    both = (F.col("bad") + F.col("good")) / (n_bad + n_good)
    part = lambda n, total, p: n * F.log(p / both) + (total - n) * F.log((1 - p + 1e-9) / (1 - both + 1e-9))
    gain = part(F.col("bad"), n_bad, bad) + F.when(F.col("good") > 0, part(F.col("good"), n_good, good)).otherwise(-n_good * F.log(1 - both + 1e-9))
    best = table.where(bad > good).withColumn("gain", gain).where("gain > 3").orderBy(F.desc("gain"), "feature").limit(MAX_FEATURES).collect()
    features = [(f, int(n)) for f, n in (r["feature"].rsplit("\t", 1) for r in best)]
    index = {f"{f}\t{n}": i for i, (f, n) in enumerate(features)}

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            numbers = [sorted(index[f] for f in fs if f in index) for fs in part.column("features").to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column("toxic"), pa.array(numbers, pa.list_(pa.int32()))], ["toxic", "features"])

    got = rows.select("toxic", "features").mapInArrow(project, "toxic int, features array<int>").collect()  # at most fit_rows rows of feature numbers
    got.sort(key=lambda r: (r["toxic"], r["features"]))  # sums in one order, whatever the partitions
    held = [np.array(r["features"], dtype=np.int64) for r in got]
    weights, bias = fit_weights(held, np.array([r["toxic"] for r in got], dtype=float), len(features))
    return Scorer(counts, features, weights, bias)


def score(docs: DataFrame, scorer: Scorer, cut: float = CUT) -> DataFrame:
    """Add ``held_out``, ``score`` and ``predicted`` to every row."""
    added = ("held_out", "score", "predicted")
    kept = [f for f in docs.schema.fields if f.name not in added]
    shared = docs.sparkSession.sparkContext.broadcast(scorer)  # bounded: alphabet^3 counts, MAX_FEATURES weights

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Scoring(shared.value)
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                scores = [model.score(t) for t in part.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(scores, pa.float64())], [*part.schema.names, "score"])

    scored = docs.select([f.name for f in kept]).mapInArrow(rows, T.StructType([*kept, T.StructField("score", T.DoubleType())]))
    return scored.withColumns({"held_out": held_out(F.col("doc_id")), "predicted": (F.col("score") >= cut).cast("int")})
