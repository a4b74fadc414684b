"""Language identification in two steps: the language family, then the language within it.

Both steps vote among one-versus-one linear support vector machines over hashed byte n-grams.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tracewright.llm.text import drop_worker_table, whole

UNDETERMINED = "und"

# Families of closely related languages, by language code.
FAMILIES = {
    "germanic": "af da de en fy is lb nb nl nn no sv yi",
    "romance": "ca es fr gl it la oc pt ro",
    "slavic": "be bg bs cs hr mk pl ru sk sl sr uk",
    "baltic": "lt lv",
    "celtic": "br cy ga gd",
    "uralic": "et fi hu se",
    "turkic": "az kk ky tr tt ug uz",
    "indic": "as bn gu hi mr ne or pa sa si ur",
    "iranian": "fa ku ps tg",
    "dravidian": "kn ml ta te",
    "semitic": "am ar he mt",
    "austronesian": "id jv mg ms su tl",
    "sinitic": "wuu yue zh",
}
FAMILY_OF = {code: family for family, codes in FAMILIES.items() for code in codes.split()}

DIMENSIONS = 8192
LONGEST_NGRAM = 4
_CHUNK = 1 << 20


@dataclass(frozen=True)
class LanguageRule:
    """``per_language`` bounds the training sample: at most so many labelled documents a language, and
    ``most_languages`` how many labels are learned.

    ``slack`` is the part of the lowest score of known documents that a document must reach, and
    ``least_calibrated`` how many of them are needed to tell that score.
    """

    per_language: int = 400
    most_languages: int = 100
    penalty: float = 4.0
    rounds: int = 30
    slack: float = 0.8
    least_calibrated: int = 50


def family(lang: str) -> str:
    """The family of a language; a language that is not listed is a family of its own."""
    return FAMILY_OF.get(lang.lower().replace("_", "-").split("-")[0], f"only {lang}")


_LETTERS = np.full(256, 32, np.uint8)
_LETTERS[128:] = np.arange(128, 256)
_LETTERS[97:123] = np.arange(97, 123)


def ngram_slots(text: str) -> Iterator[np.ndarray]:
    """Slots of all byte n-grams of the lower-cased letters, in pieces of bounded size."""
    data = np.frombuffer(text.lower().encode("utf-8", "replace"), np.uint8)
    for at in range(0, len(data), _CHUNK):
        part = _LETTERS[data[max(0, at - LONGEST_NGRAM + 1) : at + _CHUNK]].astype(np.uint32)
        gram = np.zeros(len(part), np.uint32)
        for n in range(1, LONGEST_NGRAM + 1):
            if len(part) < n:
                break
            gram = gram[: len(part) - n + 1] * np.uint32(257) + part[n - 1 :] + np.uint32(n)
            mixed = (gram ^ (gram >> np.uint32(15))) * np.uint32(2654435761)
            yield mixed >> np.uint32(32 - 13)


def features(text: str) -> np.ndarray:
    """Square roots of n-gram frequencies, scaled to length 1."""
    counts = np.zeros(DIMENSIONS, np.float64)
    for slots in ngram_slots(text):
        counts += np.bincount(slots, minlength=DIMENSIONS)
    roots = np.sqrt(counts)
    return (roots / max(np.linalg.norm(roots), 1e-9)).astype(np.float32)


def fit_svm(x: np.ndarray, y: np.ndarray, rule: LanguageRule) -> tuple[np.ndarray, float]:
    """Linear support vector machine by dual coordinate descent; the last weight is the bias."""
    x = np.hstack([x, np.ones((len(x), 1), np.float32)]).astype(np.float64)
    weights, alpha = np.zeros(x.shape[1]), np.zeros(len(x))
    squares = (x * x).sum(axis=1)
    order = np.random.default_rng(0)
    for _ in range(rule.rounds):
        for i in order.permutation(len(x)):
            gradient = y[i] * (weights @ x[i]) - 1
            step = np.clip(alpha[i] - gradient / squares[i], 0, rule.penalty) - alpha[i]
            if step:
                alpha[i] += step
                weights += step * y[i] * x[i]
    return weights[:-1].astype(np.float32), float(weights[-1])


@dataclass
class LanguageModel:
    """Machines by pair of names: positive decisions speak for the first."""

    languages: list[str]
    families: dict[str, list[str]] = field(default_factory=dict)
    machines: dict[tuple[str, str], tuple[np.ndarray, float]] = field(default_factory=dict)

    def _winner(self, names: list[str], x: np.ndarray) -> tuple[str, float]:
        """The name with most votes, then the largest sum of decisions, and how sure that is."""
        votes = {n: [0, 0.0] for n in names}
        margins: dict[str, list[float]] = {n: [] for n in names}
        for a, b in combinations(names, 2):
            weights, bias = self.machines[a, b]
            decision = float(weights @ x) + bias
            for name, d in ((a, decision), (b, -decision)):
                votes[name][0] += d > 0
                votes[name][1] += d
                margins[name].append(d)
        best = max(names, key=lambda n: (*votes[n], n))
        sure = 1 / (1 + np.exp(-3 * min(margins[best]))) if margins[best] else 1.0
        return best, float(sure)

    def predict(self, text: str) -> tuple[str, float]:
        x = features(text)
        chosen, first = self._winner(sorted(self.families), x)
        lang, second = self._winner(self.families[chosen], x)
        return lang, first * second


def training_sample(docs: DataFrame, rule: LanguageRule) -> DataFrame:
    """(lang, text) of at most ``per_language`` labelled documents with a letter, for each language.

    They are chosen by a hash of the id, over ids and labels alone; the texts are read for those only.
    """
    key = F.xxhash64(F.col("doc_id"), F.lit("language"))
    first = Window.partitionBy("lang").orderBy(key, "doc_id")
    chosen = (
        docs.where(F.col("lang").isNotNull())
        .select("doc_id", "lang")
        .withColumn("_nth", F.row_number().over(first))
        .where(F.col("_nth") <= rule.per_language)
        .select("doc_id", "lang")
    )
    return docs.select("doc_id", "lang", "text").join(
        F.broadcast(chosen.distinct()), ["doc_id", "lang"], "left_semi"
    ).where(has_letter(F.col("text"))).select("lang", "text")


def has_letter(text):
    return F.coalesce(text.rlike("\\p{L}"), F.lit(False))


def fit(docs: DataFrame, rule: LanguageRule = LanguageRule()) -> LanguageModel:
    """A model from the labelled rows of ``docs`` (doc_id, lang, text).

    Only the ``most_languages`` most frequent labels are learned, so that stray ones don't make machines
    without number. Each machine is fitted in a task of its own from its bounded part of the sample; the
    weights of all machines reach the driver.
    """
    counted = docs.where(F.col("lang").isNotNull()).groupBy("lang").count()
    common = counted.orderBy(F.desc("count"), "lang").limit(rule.most_languages).collect()
    languages = sorted(r["lang"] for r in common)
    docs = docs.where(F.col("lang").isin(languages))
    model = LanguageModel(languages)
    for lang in languages:
        model.families.setdefault(family(lang), []).append(lang)
    pairs = [(a, b, True) for a, b in combinations(sorted(model.families), 2)]
    for members in model.families.values():
        pairs += [(a, b, False) for a, b in combinations(members, 2)]
    if not pairs:
        return model
    # Each document serves the machines whose pair holds its family or its language.
    sides = {lang: [] for lang in languages}
    for k, (a, b, of_families) in enumerate(pairs):
        for lang in languages:
            name = family(lang) if of_families else lang
            if name in (a, b):
                sides[lang].append((k, 1.0 if name == a else -1.0))

    def machine_rows(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        drop_worker_table()
        for frame in frames:
            rows = [
                (k, side, x)
                for lang, text in zip(frame["lang"], frame["text"])
                for x in (features(text),)
                for k, side in sides[lang]
            ]
            yield pd.DataFrame(rows, columns=["machine", "side", "x"])

    def fitted(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        drop_worker_table()
        frame = frame.sort_values("side", kind="stable")
        weights, bias = fit_svm(np.stack(frame["x"].to_list()), frame["side"].to_numpy(), rule)
        return pd.DataFrame([(key[0], weights, bias)], columns=["machine", "weights", "bias"])

    rows = (
        training_sample(docs, rule)
        .mapInPandas(machine_rows, "machine int, side double, x array<float>")
        .groupBy("machine")
        .applyInPandas(fitted, "machine int, weights array<float>, bias double")
        .collect()
    )
    none = (np.zeros(DIMENSIONS, np.float32), 0.0)
    found = {r["machine"]: (np.asarray(r["weights"], np.float32), r["bias"]) for r in rows}
    for k, (a, b, _) in enumerate(pairs):
        model.machines[a, b] = found.get(k, none)
    return model


def least_score(held_out: DataFrame, model: LanguageModel, rule: LanguageRule = LanguageRule()) -> float:
    """The score below which a language is not told, from labelled documents the model was not fitted on.

    It is ``slack`` times the lowest score of all those whose language was found, so that documents like them
    stay; 0, which rejects nothing, if they are fewer than ``least_calibrated``.
    """
    if not model.languages:
        return 0.0
    known = held_out.where(F.col("lang").isNotNull() & has_letter(F.col("text"))).select("lang", "text")
    found = identify(known, model).where(F.col("lang_pred") == F.col("lang"))
    n, lowest = found.agg(F.count(F.lit(1)), F.min("score")).first()
    return rule.slack * lowest if n >= rule.least_calibrated else 0.0


def identify(docs: DataFrame, model: LanguageModel, least: float = 0.0) -> DataFrame:
    """Every row of ``docs`` with ``lang_pred`` and ``score`` (0 to 1), from the text alone.

    ``und`` with score 0 where the text is null or has no letter, or where nothing was learned; ``und``
    with its score where that is below ``least``. All columns stay; columns with the new names are
    replaced. Empty input gives no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("struct<lang_pred:string,score:double>")
    def predicted(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        drop_worker_table()
        learned = shared.value
        for texts, lettered in batches:
            rows = [
                learned.predict(t) if ok and learned.languages else (UNDETERMINED, 0.0)
                for t, ok in zip(texts, lettered)
            ]
            yield pd.DataFrame(rows, columns=["lang_pred", "score"])

    held = [c for c in docs.columns if c not in ("lang_pred", "score")]
    return docs.select(
        *held, predicted(whole(F.col("text")), has_letter(F.col("text"))).alias("_language")
    ).select(
        *held,
        F.when(F.col("_language.score") < least, UNDETERMINED)
        .otherwise(F.col("_language.lang_pred"))
        .alias("lang_pred"),
        "_language.score",
    )
