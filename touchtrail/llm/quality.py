"""Quality classifier: evidence of each document, joined with site rates by hierarchical empirical Bayes."""

from __future__ import annotations

import heapq
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import stored
from .common import fresh, ready, text_or_empty

TRAIN_ROWS = 20_000
SLOTS = 1 << 22
SURE = 9.0
SIGNS_TO_EXPLAIN = 3
THRESHOLD = 0.65
MAX_SHIFT = 1.0
CACHED_WORDS = 200_000
TEXTS_COUNTED = 1_000
SITE_LEVELS = ("source", "lang")
_SHAPE = 16
_WORD = re.compile(r"\w+")
_MARKS = frozenset("*#$%&@^~_=+<>\\")


def shape(text: str) -> np.ndarray:
    """What a text looks like, whatever its language: shares of signs, repetition, line ends and length."""
    words = text.split()
    out = np.zeros(_SHAPE)
    out[0] = 1.0
    if not words:
        out[1] = 1.0
        return out
    n, m = len(text), len(words)
    counts = Counter(words)
    signs = sum(map(text.count, _MARKS))
    out[2] = signs / n
    out[3] = text.count("!") / m
    out[4] = text.count("|") / m
    out[5] = sum(map(str.isupper, words)) / m
    out[6] = sum(a == b for a, b in zip(words, words[1:])) / m
    out[7] = 1 - len(counts) / m if m > 20 else 0.0
    out[8] = max(counts.values()) / m if m > 20 else 0.0
    out[9] = sum(map(str.isdigit, words)) / m
    out[10] = np.log1p(m) / 10
    out[11] = n / m / 20
    lines = [line for line in text.split("\n") if line]
    out[12] = 1 - len(set(lines)) / len(lines) if lines else 0.0
    out[13] = max((line.count("|") + line.count("!") for line in lines), default=0) / m
    out[14] = out[6] ** 0.5
    out[15] = out[2] ** 0.5
    return out


def _word_features(word: str) -> list[str]:
    """A word in lower case and its beginnings of 4 to 6 letters."""
    return [word, *("^" + word[:k] for k in (4, 5, 6) if len(word) > k)]


def _slot(feature: str) -> int:
    return xxhash.xxh64_intdigest(feature) % SLOTS


def slots(text: str) -> np.ndarray:
    """Places of a text's word features in a table of fixed size, each once."""
    words = set(_WORD.findall(text.lower()))
    return np.unique(np.array([_slot(f) for w in words for f in _word_features(w)], np.int32))


def _fit_logistic(x: np.ndarray, y: np.ndarray, penalty: float = 1e-3, rounds: int = 30) -> np.ndarray:
    """Newton's method on the logistic loss with a small ridge."""
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (p - y) / len(y) + penalty * w
        curve = (x * (p * (1 - p))[:, None]).T @ x / len(y) + penalty * np.eye(x.shape[1])
        step = np.linalg.solve(curve, gradient)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


_NO_SIGNS: dict[int, float] = {}  # one for all words without signs


@dataclass
class Model:
    """Log odds that a text is of low quality (from its shape), and that it is toxic (from its words)."""

    low: np.ndarray
    signs: dict[int, float]
    toxic: np.ndarray
    known: dict[str, dict[int, float]] = field(default_factory=dict)

    def evidence(self, text: str) -> tuple[float, float]:
        return float(shape(text) @ self.low), float(_strongest(self.signs_in(text)) @ self.toxic)

    def signs_in(self, text: str) -> list[float]:
        found: dict[int, float] = {}
        for word in set(_WORD.findall(text.lower())):
            signs = self.known.get(word)
            if signs is None:
                if len(self.known) >= CACHED_WORDS:
                    self.known.clear()
                at = (_slot(f) for f in _word_features(word))
                signs = self.known[word] = {k: self.signs[k] for k in at if k in self.signs} or _NO_SIGNS
            if signs:
                found |= signs
        return list(found.values())


def _strongest(signs: list[float]) -> np.ndarray:
    """The strongest sign and whether there are more: a long clean text does not add up to a toxic one."""
    return np.array([1.0, max(signs, default=0.0), min(len(signs), 5), float(bool(signs))])


def _sure(there: int, elsewhere: int, yes: int, no: int) -> float:
    """How much more frequent a feature is in toxic texts, as a log; 0 unless that is beyond doubt.

    It must be sixty times as frequent there, and so often that chance does not explain it (``SURE``
    nats of the likelihood ratio, which leaves about a hundred false signs among a million features, before they are chosen from).
    """
    rate = np.log((there + 0.5) / max(1, yes)) - np.log((elsewhere + 0.5) / max(1, no))
    total, share = there + elsewhere, yes / max(1, yes + no)
    ratio = there * np.log(there / (total * share)) if there and share else 0.0
    ratio += elsewhere * np.log(elsewhere / (total * (1 - share))) if elsewhere else 0.0
    return float(rate) if rate > np.log(60) and ratio > SURE else 0.0


def choose_signs(
    counts: dict[int, tuple[int, int]], toxic_texts: list[np.ndarray], yes: int, no: int
) -> dict[int, float]:
    """Signs of toxic texts, the one met in most texts first; later ones must explain what is left.

    Copies of one toxic text share all their rare words, which would pass for signs.  Once a text is
    explained by a few signs it no longer speaks for others, so those words do not.
    ``counts`` has for each candidate the toxic and the other texts it is met in, ``toxic_texts`` the
    candidates of each toxic text.
    """
    holders: dict[int, set[int]] = {}
    for k, found in enumerate(toxic_texts):
        for slot in found.tolist():
            holders.setdefault(slot, set()).add(k)
    signs: dict[int, float] = {}
    waiting = [(-len(texts), slot) for slot, texts in holders.items()]
    heapq.heapify(waiting)
    explained = Counter()
    while waiting:
        most, slot = heapq.heappop(waiting)
        left = {k for k in holders[slot] if explained[k] < SIGNS_TO_EXPLAIN}
        if len(left) < -most:
            holders[slot] = left
            if left:
                heapq.heappush(waiting, (-len(left), slot))
            continue
        if _sure(len(left), counts[slot][1], yes, no):
            signs[slot] = _sure(*counts[slot], yes, no)
            explained.update(left)
    return signs


def labelled_sample(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, limit: int = TRAIN_ROWS) -> DataFrame:
    """At most ``limit`` labelled texts, those whose ids hash lowest.

    Ids with several labels are skipped, as are ids that several rows share: a label cannot tell them
    apart.  Only ids are counted for that.
    """
    label = labels.select(F.col("doc_id").cast("bigint").alias("_id"), "quality", "toxic").where(
        "_id IS NOT NULL AND quality IS NOT NULL AND toxic IS NOT NULL"
    )
    one = label.groupBy("_id").agg(F.count("*").alias("n"), F.max("quality").alias("quality"), F.max("toxic").alias("toxic"))
    chosen = one.where("n = 1").orderBy(F.xxhash64("_id"), "_id").limit(limit).select("_id", "quality", "toxic")
    texts = docs.select(F.col(id_col).cast("bigint").alias("_id"), text_or_empty(text_col).alias("text"))
    shared = texts.join(F.broadcast(chosen), "_id").groupBy("_id").agg(F.count("*").alias("n")).where("n > 1")
    told_apart = chosen.join(shared.select("_id"), "_id", "left_anti")
    return texts.join(F.broadcast(told_apart), "_id").select("_id", "text", "quality", "toxic")


def _count_slots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many toxic and other texts of a batch hold each feature, a thousand texts at a time."""
    for batch in (whole.slice(k, TEXTS_COUNTED) for whole in batches for k in range(0, whole.num_rows, TEXTS_COUNTED)):
        sides = [[np.empty(0, np.int32)], [np.empty(0, np.int32)]]
        for text, toxic in zip(batch.column(1).to_pylist(), batch.column(3).to_pylist()):
            sides[toxic == 1].append(slots(text))
        for side, parts in enumerate(sides):
            slot, n = np.unique(np.concatenate(parts), return_counts=True)
            counts = [np.zeros(len(n), np.int64), n.astype(np.int64)]
            there, elsewhere = (counts[1], counts[0]) if side else counts
            yield pa.RecordBatch.from_arrays(
                [pa.array(slot), pa.array(there), pa.array(elsewhere)], names=["slot", "there", "elsewhere"]
            )


def train_on(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", limit: int = TRAIN_ROWS
) -> Model:
    """A model from a bounded sample of labelled rows; texts stay on the executors.

    Without labelled texts, no text is of low quality or toxic.
    """
    ready(docs.sparkSession)
    sample = stored(labelled_sample(docs, labels, id_col, text_col, limit))
    yes, no = sample.agg(F.count_if(F.col("toxic") == 1), F.count_if(F.col("toxic") != 1)).first()
    if not yes + no:
        return Model(np.eye(1, _SHAPE)[0] * -10.0, {}, np.array([-10.0, 0, 0, 0]))
    counted = sample.mapInArrow(_count_slots, "slot int, there bigint, elsewhere bigint").groupBy("slot")
    often = counted.agg(F.sum("there").alias("there"), F.sum("elsewhere").alias("elsewhere")).where("there >= 3")
    counts = {r.slot: (r.there, r.elsewhere) for r in often.toLocalIterator()}
    likely = {slot: 1.0 for slot, (there, elsewhere) in counts.items() if _sure(there, elsewhere, yes, no)}
    candidates = SparkSession.active().sparkContext.broadcast(np.array(sorted(likely), np.int32))

    def held(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [np.intersect1d(slots(t), candidates.value).tobytes() for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.binary())], names=["slots"])

    toxic_texts = sample.where("toxic = 1").mapInArrow(held, "slots binary").toLocalIterator()
    signs = choose_signs(counts, [np.frombuffer(r.slots, np.int32) for r in toxic_texts], yes, no)
    draft = SparkSession.active().sparkContext.broadcast(Model(np.zeros(_SHAPE), signs, np.zeros(4)))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).to_pylist()
            made = [np.concatenate([shape(t), _strongest(draft.value.signs_in(t))]).tobytes() for t in texts]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(made, pa.binary()), *batch.columns[2:]], names=names)

    names = ["_id", "row", "quality", "toxic"]
    made = sample.mapInArrow(rows, "_id bigint, row binary, quality int, toxic int").collect()
    made.sort(key=lambda r: (r["_id"], r["row"]))
    values = np.array([np.frombuffer(r["row"]) for r in made])
    low = np.array([r["quality"] == 0 for r in made], float)
    toxic = np.array([r["toxic"] == 1 for r in made], float)
    return Model(_fit_logistic(values[:, :_SHAPE], low), signs, _fit_logistic(values[:, _SHAPE:], toxic))


def _odds(p: Column) -> Column:
    return F.log(p / (1 - p))


def _chance(odds: Column) -> Column:
    return 1 / (1 + F.exp(-odds))


def site_posteriors(scored: DataFrame, levels: tuple[str, ...], value: str) -> DataFrame:
    """``(*levels, rate, corpus)``: rate of ``value`` at each path, shrunk towards host and corpus.

    Level one is the host, level two a path in it, and so on.  A site's prior is a beta distribution
    around the rate of the site above; how many documents that weighs is fitted by the method of
    moments to how far the rates of a level lie from those above, beyond what chance explains.
    """
    corpus = min(max(scored.agg(F.avg(value)).first()[0] or 0.0, 1e-6), 1 - 1e-6)
    above = None
    for depth in range(1, len(levels) + 1):
        keys = list(levels[:depth])
        sites = scored.groupBy(*keys).agg(F.sum(value).alias("s"), F.count("*").alias("n"))
        if above is None:
            sites = sites.withColumn("up", F.lit(corpus))
        else:
            upper = [f"_{k}" for k in range(depth - 1)]
            parent = above.select(*(F.col(c).alias(k) for c, k in zip(keys, upper)), F.col("rate").alias("up"))
            sites = sites.join(parent, _same(tuple(keys[:-1]), upper)).drop(*upper)
        sites = stored(sites)
        spread = F.col("up") * (1 - F.col("up"))
        off = F.pow(F.col("s") / F.col("n") - F.col("up"), 2)
        seen = sites.agg(F.sum(F.col("n") * off), F.sum(spread), F.sum(F.col("n") * spread)).first()
        strength = _strength(*(x or 0.0 for x in seen))
        above = stored(sites.withColumn("rate", (F.col("s") + F.lit(strength) * F.col("up")) / (F.col("n") + strength)))
    return above.select(*levels, "rate", F.lit(corpus).alias("corpus"))


def _strength(squares: float, chance: float, mass: float) -> float:
    """Documents that a prior weighs.

    For rates r around p with n documents each, the sum of n (r - p)^2 has the mean
    (1 - f) sum p (1 - p) + f sum n p (1 - p), where f = 1 / (strength + 1) is the share of the
    variance that lies between sites.
    """
    if mass <= chance:
        return 1e6
    share = (squares - chance) / (mass - chance)
    return float(np.clip(1 / max(share, 1e-9) - 1, 1.0, 1e6))


def _evidence(texts: Column, model: Model) -> Column:
    """A struct of the two log odds of a text."""
    shared = SparkSession.active().sparkContext.broadcast(model)

    def score(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([shared.value.evidence(t) for t in texts], columns=["low", "toxic"])

    return F.pandas_udf(score, "low double, toxic double")(text_or_empty(texts))


def _judged(
    rows: DataFrame, evidence: Column, sites: dict[str, DataFrame], levels: tuple[str, ...], names: list[str], threshold: float
) -> DataFrame:
    """``rows`` with chances and site rates under ``names``: p_low, p_toxic, site_low, site_toxic, keep."""
    told, keys = fresh(rows, "_told")[0], [f"_site_{k}" for k in range(len(levels))]
    out = rows.withColumn(told, evidence)
    deepest = sites["low"].select(*levels, F.col("rate").alias("r_low"), F.col("corpus").alias("c_low"))
    other = sites["toxic"].select(
        *(F.col(c).alias(k) for c, k in zip(levels, keys)), F.col("rate").alias("r_toxic"), F.col("corpus").alias("c_toxic")
    )
    both = deepest.join(other, _same(levels, keys)).select(*keys, "r_low", "c_low", "r_toxic", "c_toxic")
    out = out.join(stored(both), _same(levels, keys), "left")
    shifted = {}
    for kind in ("low", "toxic"):
        shift = _odds(F.col(f"r_{kind}")) - _odds(F.col(f"c_{kind}"))
        bounded = F.greatest(F.lit(-MAX_SHIFT), F.least(F.lit(MAX_SHIFT), shift))
        shifted[kind] = _chance(F.col(told)[kind] + F.coalesce(bounded, F.lit(0.0)))
    stay = (shifted["low"] < threshold) & (shifted["toxic"] < threshold)
    values = [shifted["low"], shifted["toxic"], F.col("r_low"), F.col("r_toxic"), stay]
    return out.select(*rows.columns, *(v.alias(n) for v, n in zip(values, names)))


def _same(left: tuple[str, ...], right: list[str]) -> Column:
    out = F.lit(True)
    for a, b in zip(left, right):
        out = out & F.col(a).eqNullSafe(F.col(b))
    return out


def _scored(docs: DataFrame, model: Model, id_col: str, text_col: str, levels: tuple[str, ...]) -> DataFrame:
    """Ids, sites and evidence of all documents, stored: texts are not needed again for rates."""
    told = _evidence(F.col(text_col), model)
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), *levels, told.alias("told"))
    return stored(rows.select("doc_id", *levels, F.col("told.low").alias("low"), F.col("told.toxic").alias("toxic")))


def _sites(scored: DataFrame, levels: tuple[str, ...]) -> dict[str, DataFrame]:
    chances = scored.select(*levels, _chance(F.col("low")).alias("low"), _chance(F.col("toxic")).alias("toxic"))
    return {kind: site_posteriors(chances, levels, kind) for kind in ("low", "toxic")}


_NAMES = ["p_low", "p_toxic", "site_low", "site_toxic", "keep"]


def classify(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    levels: tuple[str, ...] = SITE_LEVELS,
    limit: int = TRAIN_ROWS,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, p_low, p_toxic, site_low, site_toxic, keep.

    Two classifiers are trained on at most ``limit`` rows of ``labels(doc_id, quality, toxic)``:
    one for low quality from a text's shape, one for toxic texts from its words.  Every document is
    scored on its whole text (a missing one is empty).  Sites (a host, then a path in it: here
    ``levels``) get posterior rates from all their documents, shrunk towards the level above and at
    last towards the rate of the corpus.  A document's log odds move by what its site's log odds
    exceed those of the corpus, by ``MAX_SHIFT`` at most, so a site alone condemns no clean text.  A
    missing site is a site.  A document stays if both chances are below ``threshold``.
    """
    ready(docs.sparkSession)
    scored = _scored(docs, train_on(docs, labels, id_col, text_col, limit), id_col, text_col, levels)
    told = F.struct("low", "toxic")
    judged = _judged(scored, told, _sites(scored, levels), levels, _NAMES, threshold)
    return judged.select("doc_id", *_NAMES)


def keep_good(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    levels: tuple[str, ...] = SITE_LEVELS,
    limit: int = TRAIN_ROWS,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """The rows of ``docs`` that `classify` keeps, columns as they were."""
    ready(docs.sparkSession)
    model = train_on(docs, labels, id_col, text_col, limit)
    scored = _scored(docs, model, id_col, text_col, levels)
    names = fresh(docs, *_NAMES)
    judged = _judged(docs, _evidence(F.col(text_col), model), _sites(scored, levels), levels, names, threshold)
    return judged.where(F.col(names[-1])).select(*docs.columns)
