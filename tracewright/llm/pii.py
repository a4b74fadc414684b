"""Personal data: generators propose spans, boosted trees over format and context select redactions.

Base spans are found by fixed patterns and checks and always stay. Looser generators propose further,
overlapping spans; gradient-boosted trees score them by format and context, and a threshold per kind
selects among them. The marks that make a base span ("@", "+" and country code, the separators of a card, the
check digit) are masked before the trees see a span, so that a base span and the same datum in another
spelling look alike. Base spans are the positive examples and all that could be added is unlabelled, not
wrong: the threshold compares the share of base spans at a score with their share among the candidates
that look like base spans (Elkan and Noto, 2008), so that more true additions do not raise it. The
trees are compiled into one expression, so that finding spans needs no join and no user function. Main path:
DataFrame functions only.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracewright.llm.text import let, whole
from tracewright.shared_storage import settle

KINDS = ("email", "ip", "card", "phone")

# Fixed patterns. Possessive repeats and look-behinds keep the time linear in the text without
# changing what is matched: a start inside a run of the same characters fails like the run's start.
_LOCAL = "[A-Za-z0-9._%+-]"
BASE = {
    "email": rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}

_AT = r"(?:@|[(\[{]\x20?(?i:at)\x20?[)\]}])"
_DOT = r"[(\[{]\x20?(?i:dot|\.)\x20?[)\]}]"

#: High-recall generators; what they propose may overlap.
LOOSE = {
    "email": (
        rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++(?:\x20?{_DOT}\x20?{_LOCAL}++){{0,2}}\x20?{_AT}\x20?"
        rf"[A-Za-z0-9-]++(?:(?:\.|\x20?{_DOT}\x20?)[A-Za-z0-9-]++)*+",
        rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++\x20(?i:at)\x20[A-Za-z0-9-]++(?:\x20(?i:dot)\x20[A-Za-z0-9-]++)++",
    ),
    "ip": (rf"(?<![0-9.])[0-9]{{1,4}}(?:(?:\.|{_DOT})[0-9]{{1,4}}){{2,5}}(?![0-9.])",),
    "card": (r"(?<![0-9])[0-9](?:[\x20.-]{0,2}[0-9]){10,20}(?![0-9])",),
    "phone": (
        r"(?<![0-9A-Za-z])[+(]?[0-9][\x20()./0-9-]{5,22}[0-9](?![0-9A-Za-z])",
        r"(?<![0-9A-Za-z+])(?<![0-9][./-])(?:(?:\+|00)[0-9]{1,3}[\x20.-]?|1[\x20.-])?"
        r"(?:\([0-9]{2,4}\)[\x20-]?|[0-9]{2,4}[\x20./-])[0-9]{3,4}[\x20.-]?[0-9]{3,4}(?![0-9A-Za-z]|[./-][0-9])",
    ),
}

_CUES = r"(?i)(mail|contact|write|tel|phone|call|fax|mobil|card|visa|pay|karte|carte|tarjeta|ip|host|server|addr)"
_CONTEXT = 24


@dataclass(frozen=True)
class PiiRule:
    """``precision`` is what the threshold of each kind must reach on the held-out part, as estimated from base
    spans and unlabelled candidates."""

    precision: float = 0.9
    trees: int = 8
    depth: int = 3


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether the check digit fits: from the right, every second digit doubled and its digits added."""

    def value(i: Column) -> Column:
        d = F.substring(digits, F.length(digits) - i, F.lit(1)).cast("int")
        twice = F.when(d > 4, 2 * d - 9).otherwise(2 * d)
        return F.when(i % 2 == 1, twice).otherwise(d)

    places = F.sequence(F.lit(0), F.length(digits) - 1)
    return F.aggregate(places, F.lit(0), lambda total, i: total + value(i)) % 10 == 0


def _valid(kind: str, match: Column) -> Column:
    digits = _digits(match)
    if kind == "ip":
        small = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"
        return match.rlike(rf"\A{small}(?:\.{small}){{3}}\z")
    if kind == "card":
        # Checked by length first, so that no long digit string is summed up.
        return F.when(F.length(digits).between(12, 19), luhn(digits)).otherwise(F.lit(False))
    if kind == "phone":
        return F.length(digits).between(9, 15)
    return F.lit(True)


_SPAN = "struct<kind:int,start:int,end:int,match:string>"


def located(text: Column, kind: str, pattern: str) -> Column:
    """All leftmost matches that do not overlap, with code-point positions (end exclusive).

    A place is the length of all pieces and matches before it; only texts with a match are split.
    """

    def places(found: Column) -> Column:
        def add(done: Column, k: Column) -> Column:
            start = done["at"] + F.length(F.get(done["pieces"], k))
            end = start + F.length(F.get(found, k))
            span = F.struct(
                F.lit(KINDS.index(kind)).alias("kind"),
                start.cast("int").alias("start"),
                end.cast("int").alias("end"),
                F.get(found, k).alias("match"),
            )
            return F.struct(
                end.cast("int").alias("at"),
                done["pieces"].alias("pieces"),
                F.concat(done["spans"], F.array(span)).alias("spans"),
            )

        start = F.struct(
            F.lit(0).alias("at"),
            F.split(text, pattern, -1).alias("pieces"),
            F.expr(f"cast(array() as array<{_SPAN}>)").alias("spans"),
        )
        every = F.sequence(F.lit(0), F.size(found) - 1)
        return F.aggregate(every, start, add, lambda done: done["spans"])

    none = F.expr(f"cast(array() as array<{_SPAN}>)")
    return let(
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)),
        lambda found: F.when(F.size(found) == 0, none).otherwise(places(found)),
    )


def base_spans(text: Column) -> Column:
    """Spans by the fixed patterns that pass the check of their kind."""

    def of_kind(kind: str) -> Column:
        return F.filter(located(text, kind, BASE[kind]), lambda s: _valid(kind, s["match"]))

    return F.concat(*[of_kind(kind) for kind in KINDS])


def proposed_spans(text: Column) -> Column:
    """Spans of the loose generators with their surroundings."""
    spans = F.array_distinct(F.concat(*[located(text, k, pattern) for k in KINDS for pattern in LOOSE[k]]))
    before = lambda s: F.substring(
        text, F.greatest(s["start"] - _CONTEXT, F.lit(0)) + 1, F.least(s["start"], F.lit(_CONTEXT))
    )
    after = lambda s: F.substring(text, s["end"] + 1, F.lit(_CONTEXT))
    return F.transform(
        spans,
        lambda s: F.struct(
            s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"), s["match"].alias("match"),
            before(s).alias("before"), after(s).alias("after"),
        ),
    )


def masked(s: Column) -> Column:
    """The match without the marks of a base span: one spelling for every variant of the same datum."""
    m = s["match"]
    email = F.regexp_replace(m, rf"\x20?{_DOT}\x20?|\x20(?i:dot)\x20", ".")
    email = F.regexp_replace(email, rf"\x20?{_AT}\x20?|\x20(?i:at)\x20", " ")
    groups = F.regexp_replace(m, "[^0-9]+", "-")
    grouped_card = r"\A[0-9]{4}(?:-[0-9]{4}){2,3}(?:-[0-9]{1,3})?\z|\A[0-9]{4}-[0-9]{6}-[0-9]{4,5}\z"
    card = F.when(groups.rlike(grouped_card), _digits(m)).otherwise(groups)
    phone = F.regexp_replace(
        m, r"\A(?:\+|00)[0-9]{1,3}[\x20.-]*(?=\()|\A(?:\+|00)[0-9]{1,3}[\x20.-]+|\A1[\x20.-]+|\A\+", ""
    )
    phone = F.regexp_replace(F.regexp_replace(phone, r"\A[^0-9]+", ""), "[^0-9]+", "-")
    by_kind = {"email": email, "ip": F.regexp_replace(m, _DOT, "."), "card": card, "phone": phone}
    found = F.lit(None).cast("string")
    for k, kind in enumerate(KINDS):
        found = F.when(s["kind"] == k, by_kind[kind]).otherwise(found)
    return found


def possible(s: Column) -> Column:
    """Whether a proposed span passes the check of its kind in its masked spelling; others are no personal data."""
    m = masked(s)
    checks = {
        "email": m.rlike(r"\A[^\x20]+\x20[^\x20.]+(?:\.[^\x20.]+)+\z"),
        "ip": _valid("ip", m),
        "card": _valid("card", m),
        # A run of digits alone is no phone number without its plus sign; nor is a date.
        "phone": F.length(_digits(m)).between(7, 15)
        & (s["match"].rlike(r"\A\+") | m.rlike("-"))
        & ~m.rlike(r"\A(?:(?:19|20)[0-9]{2}-[0-9]{1,2}-[0-9]{1,2}|[0-9]{1,2}-[0-9]{1,2}-(?:19|20)[0-9]{2})\z"),
    }
    found = F.lit(False)
    for k, kind in enumerate(KINDS):
        found = F.when(s["kind"] == k, checks[kind]).otherwise(found)
    return found


def span_features(s: Column) -> list[Column]:
    """Format of the masked spelling and context of a proposed span; none of them tells a base span's marks."""
    count = lambda text, pattern: F.regexp_count(text, F.lit(pattern)).cast("double")
    flag = lambda c: c.cast("double")
    m = masked(s)
    # Names and addresses are free: how long those of the base spans happen to be says nothing about others.
    numeric = F.when(s["kind"].isin(KINDS.index("card"), KINDS.index("phone")), m).otherwise("")
    digit_groups = F.transform(F.regexp_extract_all(numeric, F.lit("[0-9]+"), F.lit(0)), F.length)
    return [
        s["kind"].cast("double"),
        flag(F.when(s["kind"].isin(KINDS.index("email"), KINDS.index("ip")), possible(s)).otherwise(F.lit(True))),
        count(numeric, "[0-9]"),
        count(numeric, "[0-9]+"),
        F.coalesce(F.array_max(digit_groups), F.lit(0)).cast("double"),
        F.coalesce(F.element_at(F.when(F.size(digit_groups) > 0, digit_groups), -1), F.lit(0)).cast("double"),
        flag(m.rlike("[A-Za-z]{2}\\z")),
        flag(s["before"].rlike(_CUES)),
        flag(s["before"].rlike(r"[=:#/]\s*\z")),
        flag(s["after"].rlike(r"\A\s*[%/=:]")),
        flag(s["before"].rlike(r"[0-9][^A-Za-z0-9]{0,2}\z")),
        flag(s["after"].rlike(r"\A[^A-Za-z0-9]{0,2}[0-9]")),
    ]


def _overlaps(spans: Column, s: Column) -> Column:
    return F.exists(spans, lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"]))


@dataclass(frozen=True)
class SpanSelector:
    """Compiled trees and a threshold per kind; ``None`` selects nothing beyond the base spans."""

    trees: tuple[tuple[float, str], ...]
    thresholds: tuple[float | None, ...]

    def probability(self, features: list[Column]) -> Column:
        margin = F.lit(0.0)
        for weight, described in self.trees:
            margin = margin + F.lit(weight) * compiled_tree(described, features)
        return 1 / (1 + F.exp(-2 * margin))

    def selects(self, s: Column) -> Column:
        if not self.trees:
            return F.lit(False)
        wanted = F.lit(None).cast("double")
        for kind, threshold in enumerate(self.thresholds):
            wanted = F.when(s["kind"] == kind, F.lit(threshold).cast("double")).otherwise(wanted)
        return F.coalesce(self.probability(span_features(s)) >= wanted, F.lit(False))


def compiled_tree(described: str, features: list[Column]) -> Column:
    """A regression tree, as Spark describes it, as one expression."""
    lines = [line.strip() for line in described.splitlines()[1:] if line.strip()]

    def node(at: int) -> tuple[Column, int]:
        leaf = re.match(r"Predict: (\S+)", lines[at])
        if leaf:
            return F.lit(float(leaf[1])), at + 1
        test = re.match(r"If \(feature (\d+) <= (\S+)\)", lines[at])
        low, at = node(at + 1)
        high, at = node(at + 1)
        return F.when(features[int(test[1])] <= float(test[2]), low).otherwise(high), at

    return node(0)[0]


def labelled_candidates(docs: DataFrame) -> DataFrame:
    """One row per proposed span: features, kind, and label 1 for a base span.

    Label 0 is no verdict: it says that the span is none of the base spans. Spans that overlap a base span
    without being one are left out, as they can't be added.
    """
    text = whole(F.col("text"))
    spans = docs.select("doc_id", proposed_spans(text).alias("p"), base_spans(text).alias("b")).select(
        "doc_id", "b", F.explode("p").alias("s")
    )
    same = lambda b: (b["kind"] == F.col("s.kind")) & (b["start"] == F.col("s.start")) & (b["end"] == F.col("s.end"))
    is_base = F.exists("b", same)
    return spans.where(is_base | ~_overlaps(F.col("b"), F.col("s"))).select(
        F.xxhash64("doc_id", "s.start", "s.end", "s.kind").alias("order"),
        F.col("s.kind").alias("kind"),
        is_base.cast("double").alias("label"),
        possible(F.col("s")).alias("possible"),
        *[f.alias(f"f{i}") for i, f in enumerate(span_features(F.col("s")))],
    )


def counted_candidates(docs: DataFrame) -> DataFrame:
    """How many candidates of ``docs`` share kind, label, features and part (column ``n``).

    All are counted. Features are flags and small counts, so the rows stay few however many texts there are.
    """
    found = labelled_candidates(docs)
    keys = [c for c in found.columns if c != "order"]
    held_out = F.pmod(F.xxhash64("order"), F.lit(4)) == 0
    return found.groupBy(*keys, held_out.alias("held_out")).agg(F.count(F.lit(1)).alias("n"))


def fit(docs: DataFrame, rule: PiiRule = PiiRule()) -> SpanSelector:
    """Trees and thresholds from all candidates of ``docs``.

    By a hash, three quarters fit the trees, the rest calibrates. Without examples of both sides nothing is
    learned.
    """
    nothing = SpanSelector((), (None,) * len(KINDS))
    counted = settle(counted_candidates(docs))
    columns = [c for c in counted.columns if re.fullmatch("f[0-9]+", c)]
    # Rows in a fixed order, so that the trees do not depend on how the counts were spread.
    train = counted.where(~F.col("held_out")).orderBy("label", *columns)
    if train.select("label").distinct().count() < 2:
        return nothing
    weighted = train.withColumn("weight", F.col("n").cast("double"))
    assembled = VectorAssembler(inputCols=columns, outputCol="features").transform(weighted)
    trainer = GBTClassifier(maxIter=rule.trees, maxDepth=rule.depth, weightCol="weight", seed=1)
    model: GBTClassificationModel = trainer.fit(assembled)
    trees = tuple(
        (float(w), t.toDebugString) for w, t in zip(model.treeWeights, model.trees)
    )
    learned = SpanSelector(trees, (None,) * len(KINDS))
    scored = (
        counted.where(F.col("held_out") & (F.col("possible") | (F.col("label") == 1)))
        .select("kind", "label", "n", F.floor(learned.probability([F.col(c) for c in columns]) * 100).alias("bin"))
        .groupBy("kind", "bin")
        .agg(F.sum("n").alias("n"), F.sum(F.col("label") * F.col("n")).alias("right"))
        .collect()
    )
    return SpanSelector(trees, tuple(_threshold(k, scored, rule.precision) for k in range(len(KINDS))))


def _threshold(kind: int, scored: list, precision: float) -> float | None:
    """The lowest score from which on the held-out candidates of a kind are precise enough.

    Base spans are only part of the true spans. Their share among candidates that score like base spans is
    what a score with nothing but true spans shows, so precision is measured as a part of that share.
    """
    rows = sorted((r for r in scored if r["kind"] == kind), key=lambda r: -r["bin"])
    base = sum(r["right"] for r in rows)
    if not base:
        return None
    share = sum(r["right"] * r["right"] / r["n"] for r in rows) / base
    best, n, right = None, 0, 0.0
    for row in rows:
        n, right = n + row["n"], right + row["right"]
        if row["right"] and right >= precision * share * n:
            best = row["bin"] / 100
    return best


def find(docs: DataFrame, selector: SpanSelector) -> DataFrame:
    """Every row of ``docs`` with ``base`` and ``spans``: arrays of (kind, start, end), by start, kind, end.

    ``spans`` holds the base spans and the selected ones that overlap no base span. A null
    text counts as empty and has none. All columns stay; columns with the new names are replaced.
    """
    text = whole(F.col("text"))
    held = [c for c in docs.columns if c not in ("base", "spans")]
    ordered = lambda spans: F.transform(
        F.array_sort(
            F.array_distinct(
                F.transform(
                    spans, lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"))
                )
            )
        ),
        lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end")),
    )

    def spans(base: Column) -> Column:
        if not selector.trees:
            return F.struct(ordered(base).alias("base"), ordered(base).alias("spans"))
        plain = lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"), s["match"].alias("match"))
        more = F.filter(proposed_spans(text), lambda s: ~_overlaps(base, s) & possible(s) & selector.selects(s))
        return F.struct(
            ordered(base).alias("base"), ordered(F.concat(base, F.transform(more, plain))).alias("spans")
        )

    return docs.select(*held, let(base_spans(text), spans).alias("_p")).select(*held, "_p.base", "_p.spans")


def redacted(text: Column, spans: Column) -> Column:
    """The text with every span replaced by its kind in brackets; overlapping spans become one."""
    names = F.array(*[F.lit(f"[{k}]") for k in KINDS])

    def add(done: Column, s: Column) -> Column:
        gap = F.substring(text, done["at"] + 1, F.greatest(s["start"] - done["at"], F.lit(0)))
        fresh = s["start"] >= done["at"]
        out = F.when(fresh, F.concat(done["out"], gap, F.get(names, s["kind"]))).otherwise(done["out"])
        return F.struct(F.greatest(done["at"], s["end"]).alias("at"), out.alias("out"))

    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    rest = lambda done: F.concat(
        done["out"], F.substring(text, done["at"] + 1, F.greatest(F.length(text) - done["at"], F.lit(0)))
    )
    return F.aggregate(spans, start, add, rest)


def joined(spans: Column) -> Column:
    """kind:start:end of all spans, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(
            spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))
        ),
        ",",
    )
