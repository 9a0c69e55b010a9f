"""Mixing to target weights with soft membership.

A classifier learned from a table of labelled documents predicts for every document how likely each
domain is. Document rates are then fitted so that the expected tokens of each domain come to the
wanted share of all tokens: nonnegative least squares, solved by projected gradient steps.

The only bound of a rate is zero, unless the caller sets a cap. Whether the wanted shares can be reached
then depends on the documents, so the shares that are reached are returned next to them.

A document's step depends on its posteriors alone, so documents with equal posteriors keep equal
rates. Posteriors are rounded to a grid, tokens are added up per grid point, and the steps run on that
table in parallel. The gradients of all steps, a few numbers each, then give any document its rate.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import HashingTF, Normalizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from passagemill.llm.common import greatest_label, let, texts_of, words_column
from passagemill.session import stage

#: About so many labelled rows are learned from at most, chosen by a hash of their key. Each domain may
#: fill an equal part of them, and what rare ones leave goes to the others.
LABELLED_ROWS = 20_000

#: Hashed word features of the classifier.
FEATURES = 1 << 13

#: Posteriors are multiples of one over this.
GRID = 64

#: The cap of a document's rate in the registered mixture: no document is taken more often.
MOST = 4.0

#: The pull of rates towards 1.
PULL = 1e-3

#: Steps end when the shares move by less than this part of their scale, or when all are as near to
#: their targets; at the latest after so many steps, which the fit then reports as not converged.
STILL = 1e-4
STEPS = 400


class DomainModel(NamedTuple):
    """Domains in order and the classifier; without one, every document is of the first domain."""

    domains: list[str]
    classifier: LogisticRegressionModel | None

    def posteriors(self, rows: DataFrame) -> DataFrame:
        """``row, text`` to ``row, n_tokens, grid``: posteriors in units of one over ``GRID``."""
        worded = _worded(rows).withColumn("n_tokens", F.size("words").cast("long"))
        if self.classifier is None:
            return worded.select("row", "n_tokens", F.array(F.lit(GRID)).alias("grid"))
        found = self.classifier.transform(_features(worded))
        return found.select("row", "n_tokens", _grid(vector_to_array("probability")).alias("grid"))


def _grid(posteriors: Column) -> Column:
    """Posteriors in units of one over ``GRID``; the greatest is one unit at least, however many
    domains share the rest."""
    return let(
        posteriors,
        lambda all_of: F.transform(
            all_of,
            lambda one: F.greatest(
                F.round(one * GRID), (one == F.array_max(all_of)).cast("double")
            ).cast("int"),
        ),
    )


def _worded(rows: DataFrame) -> DataFrame:
    return rows.withColumn("words", words_column(F.lower("text"))).drop("text")


def _features(worded: DataFrame) -> DataFrame:
    hashed = HashingTF(inputCol="words", outputCol="hashed", numFeatures=FEATURES).transform(worded)
    return Normalizer(inputCol="hashed", outputCol="features").transform(hashed).drop("words", "hashed")


def _level(counts: list[int], limit: int) -> float:
    """The part of ``limit`` that each domain may fill, so that the parts that are filled come to it."""
    left = float(limit)
    for at, count in enumerate(sorted(counts)):
        part = left / (len(counts) - at)
        if count > part:
            return part
        left -= count
    return float(max(counts, default=0))


def domain_sample(documents: DataFrame, labelled: DataFrame, limit: int) -> DataFrame:
    """``doc_id, text, domain, weight`` of about ``limit`` labelled rows at most, drawn within each domain.

    ``weight`` is how many labelled rows of its domain a row stands for, so domains keep their odds.
    """
    marked = greatest_label(labelled.where("domain is not null"), "domain")
    counts = marked.groupBy("domain").count()
    level = _level([row["count"] for row in counts.collect()], limit)
    shares = counts.select("domain", F.least(F.lit(1.0), F.lit(level) / F.col("count")).alias("share"))
    lot = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) / F.lit(float(1 << 20))
    chosen = marked.join(F.broadcast(shares), "domain").where(lot < F.col("share"))
    return texts_of(documents, chosen.select("doc_id", "domain", (1 / F.col("share")).alias("weight")))


def fit_domains(documents: DataFrame, labelled: DataFrame, limit: int = LABELLED_ROWS) -> DomainModel:
    """Learn ``labelled(doc_id, domain)`` from about ``limit`` rows at most.

    Rows without a domain are left out. With no labelled document or a single domain there is
    nothing to tell apart, and every document is of that one.
    """
    sample = stage(domain_sample(documents, labelled, limit), "mixing-sample")
    domains = sorted(row["domain"] for row in sample.select("domain").distinct().collect())
    if len(domains) < 2:
        return DomainModel(domains or ["all"], None)
    names = F.array(*[F.lit(name) for name in domains])
    rows = sample.withColumn("label", (F.array_position(names, F.col("domain")) - 1).cast("double"))
    fitted = LogisticRegression(
        family="multinomial", maxIter=25, regParam=1e-4, weightCol="weight"
    ).fit(_features(_worded(rows.select("text", "label", "weight"))))
    return DomainModel(domains, fitted)


class Rates(NamedTuple):
    """Everything that gives a grid point its rate: the gradients and the momentum of all steps.

    ``targets`` and ``achieved`` are each domain's wanted and expected share of all tokens;
    ``converged`` says whether the steps came to rest.
    """

    domains: list[str]
    targets: np.ndarray
    achieved: np.ndarray
    gradients: np.ndarray
    momentum: np.ndarray
    most: float
    pull: float
    converged: bool = True

    def _replayed(self, posteriors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        rate = ahead = np.ones(len(posteriors))
        for gradient, momentum in zip(self.gradients, self.momentum, strict=True):
            moved = ahead - (posteriors @ gradient + self.pull * (ahead - 1)) / (1 + self.pull)
            after = np.clip(moved, 0.0, self.most)
            ahead = after + momentum * (after - rate)
            rate = after
        return rate, ahead

    def of(self, posteriors: np.ndarray) -> np.ndarray:
        """Replay the steps for some posteriors (rows x domains)."""
        return self._replayed(posteriors)[0]

    def ahead(self, posteriors: np.ndarray) -> np.ndarray:
        """Where the next gradient is taken."""
        return self._replayed(posteriors)[1]


def _shares(grid: np.ndarray) -> np.ndarray:
    total = grid.sum(axis=1, keepdims=True)
    return grid / np.maximum(total, 1)


def expected_shares(cells: DataFrame, rates: Rates, total: int) -> tuple[np.ndarray, np.ndarray]:
    """Expected tokens per domain, as shares of all tokens: at the rates, and at the point ahead."""

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((2, len(rates.domains)))
        for batch in batches:
            if batch.num_rows:
                grid = _shares(np.array(batch.column(0).to_pylist(), dtype=np.float64))
                sums += (np.stack(rates._replayed(grid)) * batch.column(1).to_numpy()) @ grid
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(len(rates.domains))), pa.array(sums[0]), pa.array(sums[1])],
            ["domain", "now", "ahead"],
        )

    rows = cells.mapInArrow(summed, "domain long, now double, ahead double")
    found = rows.groupBy("domain").agg(F.sum("now").alias("now"), F.sum("ahead").alias("ahead")).collect()
    shares = np.zeros((2, len(rates.domains)))
    for row in found:
        shares[:, row["domain"]] = row["now"], row["ahead"]
    return tuple(shares / max(total, 1))


def fit_rates(
    posteriors: DataFrame, domains: list[str], targets: dict[str, float],
    most: float | None = None, pull: float = PULL, steps: int = STEPS,
) -> Rates:
    """Rates under which expected domain tokens come to the targets, as near as the documents allow.

    ``targets`` are weights. A domain of weight 0 is to vanish; one that is not named keeps its share;
    one without tokens is left out. The rest share what is left in proportion. Rates are at most
    ``most``, if it is given.
    """
    cells = stage(
        posteriors.groupBy("grid").agg(F.sum("n_tokens").alias("tokens")).where("tokens > 0"),
        "mixing-cells",
    )
    total = cells.agg(F.sum("tokens")).first()[0] or 0
    none = np.zeros(len(domains))
    cap = np.inf if most is None else most
    rates = Rates(domains, none, none, np.zeros((0, len(domains))), np.zeros(0), cap, pull)
    now, ahead = expected_shares(cells, rates, total)
    rates = rates._replace(targets=now, achieved=now)
    weights = np.array([targets.get(name, 0.0) for name in domains])
    named = np.array([name in targets for name in domains]) & (now > 0)
    if not total or weights[named].sum() <= 0:
        return rates
    wanted = np.where(named, weights * (1 - now[~named].sum()) / weights[named].sum(), now)
    # errors relative to the greater of both shares: no step overshoots, and none is divided by zero
    scale = np.maximum(np.maximum(wanted, now), np.finfo(float).tiny)
    rates = rates._replace(targets=wanted)
    since = 0
    for _ in range(steps):
        before = now
        rates = rates._replace(
            gradients=np.vstack([rates.gradients, (ahead - wanted) / scale]),
            momentum=np.append(rates.momentum, since / (since + 3.0)),
        )
        gradient = rates.gradients[-1]
        now, ahead = expected_shares(cells, rates, total)
        # momentum that leads uphill starts anew
        since = 0 if gradient @ (now - before) > 0 else since + 1
        rates = rates._replace(achieved=now)
        moved = np.abs(now - before) / scale
        if max(moved.max(), (np.abs(ahead - now) / scale).max()) < STILL:
            return rates
        if (np.abs(now - wanted) / scale).max() < STILL:
            return rates
    return rates._replace(converged=False)


def rate_column(grid: Column, rates: Rates) -> Column:
    """The fitted rate of a row's grid point."""

    @F.pandas_udf("double")
    def rate(column: pd.Series) -> pd.Series:
        if not len(column):
            return pd.Series([], dtype="float64")
        return pd.Series(rates.of(_shares(np.array(column.tolist(), dtype=np.float64))))

    return rate(grid)


def copies(rate: Column, *key: Column) -> Column:
    """How often a document is taken: its rate rounded up or down, by a hash of its key, so that the
    mean is the rate."""
    lot = F.pmod(F.xxhash64(*key, F.lit("mixing")), F.lit(1 << 30)) / F.lit(float(1 << 30))
    return F.floor(rate + lot).cast("long")


def mixed_rates(
    documents: DataFrame, labelled: DataFrame, targets: dict[str, float], most: float | None = None
) -> tuple[DataFrame, Rates]:
    """``row, n_tokens, grid, rate, copies`` per document, and the fit.

    ``row`` is the document as it is. Null and empty texts have no tokens and the rate of their
    posteriors. Each id and text have a lot of their own, so rows without id and unlike texts under one
    id are drawn apart; rows that repeat both are taken equally often. An empty table gives an empty
    table.
    """
    own = F.struct(*[F.col(f"`{name}`") for name in documents.columns]).alias("row")
    model = fit_domains(documents.select("doc_id", "text"), labelled)
    rows = documents.select(own, F.coalesce("text", F.lit("")).alias("text"))
    known = stage(model.posteriors(rows), "mixing-posteriors")
    rates = fit_rates(known.select("n_tokens", "grid"), model.domains, targets, most)
    rated = known.withColumn("rate", rate_column(F.col("grid"), rates))
    return rated.withColumn("copies", copies(F.col("rate"), F.col("row.doc_id"), F.col("row.text"))), rates


def mix(
    documents: DataFrame, labelled: DataFrame, targets: dict[str, float], most: float | None = None
) -> DataFrame:
    """The documents with their own columns, each as often as its rate says."""
    rated, _ = mixed_rates(documents, labelled, targets, most)
    taken = rated.where("copies > 0").select("row", F.explode(F.sequence(F.lit(1), "copies")))
    return taken.select("row.*")


def labelled_domains(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, domain`` of the labelled documents: their language and their quality label."""
    known = documents.select("doc_id", "lang").join(labels.select("doc_id", "quality"), "doc_id")
    return known.select("doc_id", F.concat_ws(":", "lang", "quality").alias("domain")).where(
        "domain like '%:_'"
    )


#: Wanted shares of the languages, and of documents of quality 1 in each.
LANGUAGES = {"en": 0.55, "fr": 0.17, "de": 0.16, "es": 0.12}
GOOD = 0.97


def language_targets(weights: dict[str, float] = LANGUAGES, good: float = GOOD) -> dict[str, float]:
    """Weights per domain ``language:quality``: ``good`` of each language's share is of quality 1."""
    return {
        f"{lang}:{quality}": weight * (good if quality else 1 - good)
        for lang, weight in weights.items()
        for quality in (0, 1)
    }
