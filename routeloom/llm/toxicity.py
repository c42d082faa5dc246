"""Toxicity by weak supervision.

Many voters look at a text: fixed lexicons by theme and language, words and word beginnings mined from
labelled rows, and patterns of address and shouting.  Each votes toxic, clean or abstains.  A
generative label model learns, by expectation and maximisation over the votes
alone, how often each voter is right and which voters are correlated; a group of correlated voters counts as
about one.  The posterior labels train a linear
classifier on words and word beginnings, which scores every text.

Defined results: null and empty texts have no feature and get the score of the
intercept; without labelled rows of both classes the score is 0.5 for all;
a document labelled twice counts once; repeated rows each give a row; other
columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from routeloom.llm.labelled import class_weights, fit_logistic, fold_of, sigmoid, training_rows
from routeloom.session import ship, written

#: Labelled rows of a class that the model learns from, at most.
SAMPLE_ROWS = 3_000
#: Mined voters of either kind, features of the classifier, at most.
MINED, FEATURES = 120, 512
#: A feature of fewer labelled rows is not used, nor one with a lesser z as a voter.
LEAST_ROWS, LEAST_Z = 5, 5.0
#: Voters whose votes correlate more than this, given the class, share their weight.
CORRELATED = 0.5

# Common insults and threats of four languages, a voter each.
LEXICONS = {
    "english insults": "clown coward creep disgusting dumb fool freak garbage idiot imbecile jerk loser moron pathetic pig scum stupid trash ugly worthless",
    "english threats": "beat burn choke destroy die hang hurt kill punch rot smash stab strangle",
    "german insults": "abschaum arsch blödmann depp dumm dummkopf feigling hässlich idiot ekelhaft müll schwein trottel versager wertlos widerlich",
    "french insults": "abruti bête connard crétin débile dégoûtant imbécile idiot laid lâche minable nul ordure pourriture raté stupide",
    "spanish insults": "asqueroso basura bobo cerdo cobarde escoria estúpido feo fracasado idiota imbécil inútil necio payaso patético tonto",
}
LEXICON = tuple(LEXICONS["english insults"].split())
_LISTED = {name: frozenset(words.split()) for name, words in LEXICONS.items()}
_EVERY = frozenset().union(*_LISTED.values())

_WORD = re.compile(r"\w+")
_ANY = "|".join(sorted(_EVERY))
_PATTERNS = {
    "address": re.compile(r"\b(?:you|your|u|du|ihr|dein\w*|tu|vous|ton|tes|tú|eres|usted)\s+(?:\w+\s+){0,2}(?:" + _ANY + r")\b", re.I),
    "shouted": re.compile(r"\b(?:" + "|".join(w.upper() for w in sorted(_EVERY)) + r")\b"),
    "spaced": re.compile(r"\b(?:" + "|".join(r"[\W_]".join(w) for w in LEXICON) + r")\b", re.I),
    "repeated marks": re.compile(r"[!?]{3,}"),
}


def features_of(text: str) -> set[str]:
    """Words, and beginnings of four and five letters (with a mark)."""
    words = set(_WORD.findall(text.lower()))
    out = set(words)
    for w in words:
        if len(w) > 4:
            out.add("^" + w[:4])
            if len(w) > 5:
                out.add("^" + w[:5])
    return out


@dataclass
class ToxicityModel:
    """Linear classifier, and the label model it learned from."""

    features: list[str]
    weights: np.ndarray | None
    voters: list[str] = field(default_factory=list)
    accuracy: np.ndarray | None = None
    strength: np.ndarray | None = None


def _mined(rows: DataFrame, toxic_rows: int, clean_rows: int) -> list[tuple[str, float]]:
    """(feature, z) of the features that tell the classes apart best, of at least ``LEAST_ROWS`` rows.

    ``z`` compares the shares of toxic and of clean rows that have the feature; a
    few chance hits in one class do not make it large.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                features, given = [], []
                for text, label in zip(*(c.to_pylist() for c in batch.slice(at, 64).columns), strict=True):
                    found = sorted(features_of(text))
                    features += found
                    given += [label] * len(found)
                yield pa.RecordBatch.from_arrays([pa.array(features, pa.string()), pa.array(given, pa.int32())], ["feature", "label"])

    counted = (
        rows.select("text", "label")
        .mapInArrow(run, "feature string, label int")
        .groupBy("feature")
        .agg(F.sum("label").alias("toxic"), F.sum(1 - F.col("label")).alias("clean"))
        .where(F.col("toxic") + F.col("clean") >= LEAST_ROWS)
    )
    share = (F.col("toxic") + F.col("clean")) / float(toxic_rows + clean_rows)
    spread = F.sqrt(share * (1 - share) * (1 / toxic_rows + 1 / clean_rows) + 1e-12)
    z = F.round((F.col("toxic") / float(toxic_rows) - F.col("clean") / float(clean_rows)) / spread, 6)
    found = written(counted.select("feature", z.alias("z")), "mined")  # both ends are read of it
    best = [found.orderBy(F.desc("z") if up else F.asc("z"), "feature").limit(FEATURES) for up in (True, False)]
    return sorted({(r["feature"], r["z"]) for part in best for r in part.collect()})


class Voters:
    """Votes of one text: +1 toxic, -1 clean, 0 none."""

    def __init__(self, toxic: list[str]):
        self.toxic = toxic
        self.suspects = frozenset(toxic) | _EVERY
        self.names = [*toxic, *_LISTED, *_PATTERNS, "no suspect"]

    def __call__(self, text: str) -> list[int]:
        seen = features_of(text)
        return [
            *(1 if f in seen else 0 for f in self.toxic),
            *(0 if seen.isdisjoint(words) else 1 for words in _LISTED.values()),
            *(1 if p.search(text) else 0 for p in _PATTERNS.values()),
            -1 if seen.isdisjoint(self.suspects) else 0,
        ]


def label_model(votes: np.ndarray, prior: float, steps: int = 50, weight: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(posterior of toxic, accuracy of each voter, strength of each voter) from votes alone.

    A voter that votes is right with a probability of its own; when it abstains it
    says nothing.  ``prior`` is the share of the toxic class; ``weight`` says how much
    each row counts, relative to the others.  Accuracies begin at 0.8 and are kept from 0.55 to 0.995, so that
    the two classes cannot trade places.  The model has correlations as well: in each step
    those of what the two classes leave of the votes are had, and a voter's strength, one over the
    sum of its correlations beyond ``CORRELATED`` (its own included), weighs its vote in the next
    posterior, so a group of voters that say the same is about one voter while accuracies are learned.
    """
    n, m = votes.shape
    share = np.ones(n) if weight is None else weight / weight.mean()
    cast, toxic = (votes != 0).astype(float), (votes > 0).astype(float)
    accuracy, strength = np.full(m, 0.8), np.ones(m)
    posterior = np.full(n, prior)
    for _ in range(steps):
        before = posterior
        posterior = sigmoid(votes @ (strength * np.log(accuracy / (1 - accuracy))) + np.log(prior / (1 - prior)))
        right = (share * posterior) @ toxic + (share * (1 - posterior)) @ (cast - toxic)
        accuracy = np.clip((right + 4.0) / (share @ cast + 5.0), 0.55, 0.995)
        strength = 0.5 * strength + 0.5 / np.maximum(1.0, _correlated(votes, posterior, share))
        if np.abs(posterior - before).max() < 1e-6:
            break
    posterior = sigmoid(votes @ (strength * np.log(accuracy / (1 - accuracy))) + np.log(prior / (1 - prior)))
    return posterior, accuracy, strength


def _correlated(votes: np.ndarray, posterior: np.ndarray, share: np.ndarray) -> np.ndarray:
    """For each voter the sum of its correlations beyond ``CORRELATED``, given the class."""
    member = np.stack([1 - posterior, posterior]) + 1e-9
    mean = (member * share) @ votes / (member * share).sum(axis=1, keepdims=True)  # of each voter under either class
    left = votes - member.T @ mean
    spread = np.sqrt(share @ left**2 / len(votes)) + 1e-9
    correlation = np.clip(((left * share[:, None]).T @ left) / len(votes) / spread[:, None] / spread, -1, 1)
    return (np.abs(correlation) * (np.abs(correlation) > CORRELATED)).sum(axis=1)


def fit_toxicity(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS, id_col: str = "doc_id", text_col: str = "text") -> ToxicityModel:
    """Learn from at most ``sample_rows`` labelled rows of each class."""
    ship(docs.sparkSession)
    rows = training_rows(docs, labels, "toxic", sample_rows, id_col, text_col)
    sizes = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}
    mined = _mined(rows, sizes[1], sizes[0]) if set(sizes) == {0, 1} else []
    if not mined:
        return ToxicityModel([], None)
    ranked = sorted(mined, key=lambda r: (-r[1], r[0]))
    toxic = [f for f, z in ranked if z >= LEAST_Z][:MINED]
    half = FEATURES // 2
    features = [f for f, _ in ranked[:half]] + [f for f, _ in ranked[half:][-half:]]
    voters = Voters(toxic)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = {f: k for k, f in enumerate(features)}
        for batch in batches:
            texts = batch.column(1).to_pylist()
            votes = [bytes(v + 1 for v in voters(t)) for t in texts]
            seen = [sorted(place[f] for f in features_of(t) if f in place) for t in texts]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(votes, pa.binary()), pa.array(seen, pa.list_(pa.int32()))], ["draw", "label", "votes", "seen"])

    got = rows.select(F.xxhash64("doc_id").alias("draw"), "text", "label").mapInArrow(run, "draw long, label int, votes binary, seen array<int>").collect()
    got = sorted(got, key=lambda r: (r["draw"], bytes(r["votes"])))  # at most 2 * sample_rows rows
    votes = np.array([np.frombuffer(bytes(r["votes"]), np.uint8) for r in got]).astype(np.int8) - 1
    stands_for = class_weights(labels, "toxic", sample_rows, id_col)
    weight = np.array([stands_for[r["label"]] for r in got])
    labelled = {k: sizes[k] * stands_for[k] for k in (0, 1)}
    posterior, accuracy, strength = label_model(votes, prior=labelled[1] / (labelled[0] + labelled[1]), weight=weight)
    x = np.zeros((len(got), len(features)))
    for k, r in enumerate(got):
        x[k, r["seen"]] = 1.0
    weights = fit_logistic(x, posterior, ridge=2e-4, steps=25, weight=weight)
    return ToxicityModel(features, weights, voters.names, accuracy, strength)


def score_toxicity(docs: DataFrame, model: ToxicityModel, threshold: float = 0.5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, held_out, score, predicted."""
    ship(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"), (fold_of(id_col) == 0).alias("held_out"))
    if model.weights is None:
        found = rows.select("doc_id", "held_out", F.lit(0.5).alias("score"))
    else:
        held = docs.sparkSession.sparkContext.broadcast(model)  # FEATURES weights and names
        kind = rows.schema["doc_id"].dataType.simpleString()

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            w = held.value.weights
            weight, base = dict(zip(held.value.features, w[:-1].tolist(), strict=True)), float(w[-1])
            known = frozenset(weight)
            for batch in batches:
                x = np.array([base + sum(weight[f] for f in sorted(features_of(t.as_py()) & known)) for t in batch.column(1)])
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(sigmoid(x))], ["doc_id", "held_out", "score"])

        found = rows.mapInArrow(run, f"doc_id {kind}, held_out boolean, score double")
    return found.select(F.col("doc_id").alias(id_col), "held_out", "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
