"""From a feature set to a numeric training table, and the same for scoring rows.

Every step learns from the training rows and is replayed unchanged on others.
"""

from __future__ import annotations

import json
import re
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark import inheritable_thread_target
from pyspark.ml import PipelineModel
from pyspark.ml.classification import DecisionTreeClassifier
from pyspark.ml.feature import IndexToString, StringIndexer, VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ebbtide.functions.exprs import exprs, quoted
from ebbtide.functions.skew import stable
from ebbtide.ml import registry
from ebbtide.operators.quality import flat_columns

MAX_CATEGORIES = 2000


# ---- square roots, scaling ------------------------------------------------

def sqrt_transform(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.withColumns({f"sqrt_{c}": F.sqrt(F.col(c).cast("double")) for c in columns})


def maxabs_fit(df: DataFrame, columns: Sequence[str]) -> dict[str, float]:
    """Greatest absolute value per column; 1 where a column is empty or all zero."""
    row = df.agg(*exprs(f"max(abs(CAST(`{c}` AS DOUBLE))) AS `{c}`" for c in columns)).first()
    return {c: row[c] or 1.0 for c in columns}


def maxabs_scale(df: DataFrame, maxes: Mapping[str, float]) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("double") / F.lit(m) for c, m in maxes.items()})


# ---- one-hot --------------------------------------------------------------

def column_name(column: str, value: str) -> str:
    return f"{column}_{re.sub(r'[^0-9A-Za-z]+', '_', value).strip('_')}"


@dataclass
class OneHot:
    """Learned categories: input column to [(output column, values)]; outputs are unique."""

    categories: dict[str, list[tuple[str, list[str]]]]

    @classmethod
    def fit(cls, df: DataFrame, columns: Sequence[str],
            max_categories: int = MAX_CATEGORIES) -> OneHot:
        """A column with more categories than the limit is an error.

        A name that another category has taken gets a number, in the order of the categories.
        """
        if not columns:
            return cls({})
        pairs = F.explode(F.array(*[
            F.struct(F.lit(c).alias("name"), F.col(c).cast("string").alias("value"))
            for c in columns])).alias("p")
        found = (df.select(pairs).select("p.*").where(F.col("value").isNotNull())
                 .groupBy("name", "value").agg(F.count(F.lit(1)).alias("n")))
        sizes = found.groupBy("name").agg(F.count(F.lit(1)).alias("n")).where(
            F.col("n") > max_categories).collect()
        if sizes:
            raise ValueError(f"more than {max_categories} categories in "
                             f"{sorted(r['name'] for r in sizes)}")
        values = sorted((columns.index(r["name"]), r["name"], r["value"])
                        for r in found.select("name", "value").collect())
        categories: dict[str, list[tuple[str, list[str]]]] = {c: [] for c in columns}
        taken = set(columns)
        for _, name, value in values:
            wanted = out = column_name(name, value)
            number = 2
            while out in taken:
                out, number = f"{wanted}_{number}", number + 1
            taken.add(out)
            categories[name].append((out, [value]))
        return cls(categories)

    @property
    def outputs(self) -> list[str]:
        return [out for pairs in self.categories.values() for out, _ in pairs]

    def transform(self, df: DataFrame) -> DataFrame:
        """Fixed 0/1 columns in a fixed order; unknown and missing values give all zeros."""
        return df.selectExpr("*", *[
            f"coalesce(CAST(CAST(`{c}` AS STRING) IN ({', '.join(map(quoted, values))}) AS INT), 0)"
            f" AS `{out}`" for c, pairs in self.categories.items() for out, values in pairs])


# ---- imputation -----------------------------------------------------------

def _helpers_filled(df: DataFrame, helpers: Sequence[str]) -> DataFrame:
    return df.selectExpr("*", *[
        f"coalesce(CAST(`{h}` AS DOUBLE), 0.0D) AS `_h_{h}`" for h in helpers])


@dataclass
class Imputer:
    """Per column a model that predicts missing values from always-present helpers."""

    helpers: list[str]
    linear: dict[str, tuple[float, list[float]]] = field(default_factory=dict)
    trees: dict[str, PipelineModel] = field(default_factory=dict)

    @classmethod
    def fit(cls, df: DataFrame, strategies: Mapping[str, str], helpers: Sequence[str], *,
            threads: int = 4) -> Imputer:
        """The fits run side by side, each on all known rows of its column."""
        out = cls(list(helpers))
        inputs = [f"_h_{h}" for h in helpers]
        assembler = VectorAssembler(inputCols=inputs, outputCol="_hx")
        filled = _helpers_filled(df.select(*helpers, *strategies), helpers)

        def fit_one(job: tuple[str, str]) -> None:
            column, strategy = job
            known = filled.where(F.col(column).isNotNull())
            if known.isEmpty():
                return
            if strategy == "regression":
                rows = assembler.transform(known.withColumn("_y", F.col(column).cast("double")))
                model = LinearRegression(
                    featuresCol="_hx", labelCol="_y", solver="normal", regParam=1e-6).fit(rows)
                out.linear[column] = (model.intercept, [float(c) for c in model.coefficients])
                return
            indexer = StringIndexer(inputCol=column, outputCol="_y",
                                    stringOrderType="alphabetAsc")
            labels = indexer.fit(known)
            tree = DecisionTreeClassifier(
                featuresCol="_hx", labelCol="_y", predictionCol="_guess",
                rawPredictionCol="", probabilityCol="", maxDepth=8, seed=1)
            model = tree.fit(assembler.transform(labels.transform(known)))
            back = IndexToString(inputCol="_guess", outputCol="_text", labels=labels.labels)
            out.trees[column] = PipelineModel([assembler, model, back])

        with ThreadPoolExecutor(threads) as pool:
            list(pool.map(inheritable_thread_target(df.sparkSession)(fit_one),
                          strategies.items()))
        return out

    def save(self, path: str) -> dict:
        """Writes the trees below path; returns the rest as plain values."""
        for number, column in enumerate(sorted(self.trees)):
            self.trees[column].write().overwrite().save(f"{path}/tree_{number}")
        return {"helpers": self.helpers, "linear": self.linear, "trees": sorted(self.trees)}

    @classmethod
    def load(cls, path: str, state: dict) -> Imputer:
        trees = {column: PipelineModel.load(f"{path}/tree_{number}")
                 for number, column in enumerate(state["trees"])}
        linear = {c: (intercept, list(w)) for c, (intercept, w) in state["linear"].items()}
        return cls(list(state["helpers"]), linear, trees)

    def transform(self, df: DataFrame) -> DataFrame:
        """Fills the missing values; known values stay."""
        columns = df.columns
        done = _helpers_filled(df, self.helpers)
        for column, (intercept, coefficients) in self.linear.items():
            guess = F.lit(float(intercept))
            for h, c in zip(self.helpers, coefficients):
                guess = guess + F.col(f"_h_{h}") * F.lit(c)
            done = done.withColumn(column, F.coalesce(F.col(column).cast("double"), guess))
        for column, model in sorted(self.trees.items()):
            done = model.transform(done).withColumn(
                column, F.coalesce(F.col(column), F.col("_text"))).drop(
                "_hx", "_guess", "_text")
        return done.select(*columns)


# ---- everything together --------------------------------------------------

@dataclass
class Preparation:
    """Learned steps: imputer, encoder and the list of usable columns."""

    product: str
    imputer: Imputer
    encoder: OneHot
    numeric: list[str]
    roots: list[str]

    @property
    def eligible(self) -> list[str]:
        return [*self.numeric, *[f"sqrt_{c}" for c in self.roots], *self.encoder.outputs]

    @classmethod
    def fit(cls, features: DataFrame, product: str, *, roots: Sequence[str] = ()
            ) -> tuple[Preparation, DataFrame]:
        """Learns on the training rows; returns the imputed rows as well, already stored.

        ``features`` is read several times: give a stored table.
        """
        roles = registry.feature_registry(features.columns, product)
        strategies = {c: s for c, s in registry.IMPUTED.items() if c in roles}
        helpers = [h for h in registry.HELPERS if h in roles]
        imputer = Imputer.fit(features, strategies, helpers)
        filled = stable(imputer.transform(features))
        continuous = [c for c, r in roles.items() if r == "continuous"]
        flat = set(flat_columns(filled, continuous))
        factors = [c for c, r in roles.items() if r == "factor"]
        encoder = OneHot.fit(filled, [c for c in factors if c not in registry.FLAGS])
        numeric = [c for c in continuous if c not in flat and c not in roots]
        numeric += [c for c in factors if c in registry.FLAGS]
        return cls(product, imputer, encoder, numeric,
                   [c for c in roots if c not in flat]), filled

    def save(self, path: str, spark: SparkSession) -> None:
        """Model folders, and one small JSON row for the rest."""
        state = {"product": self.product, "numeric": self.numeric, "roots": self.roots,
                 "categories": self.encoder.categories, "imputer": self.imputer.save(path)}
        spark.createDataFrame([(json.dumps(state),)], "state string").write.mode(
            "overwrite").parquet(f"{path}/state")

    @classmethod
    def load(cls, path: str, spark: SparkSession) -> Preparation:
        state = json.loads(spark.read.parquet(f"{path}/state").first()["state"])
        encoder = OneHot({c: [(out, list(values)) for out, values in pairs]
                          for c, pairs in state["categories"].items()})
        return cls(state["product"], Imputer.load(path, state["imputer"]), encoder,
                   state["numeric"], state["roots"])

    def encode(self, filled: DataFrame, keep: Sequence[str]) -> DataFrame:
        """Imputed rows to ``keep`` plus the usable columns."""
        encoded = self.encoder.transform(sqrt_transform(filled, self.roots))
        extra = [c for c in keep if c not in self.eligible]
        return encoded.select(*extra, *self.eligible)

    def transform(self, features: DataFrame, keep: Sequence[str]) -> DataFrame:
        return self.encode(self.imputer.transform(features), keep)


# ---- missing values for the learners --------------------------------------

def columns_with_nulls(df: DataFrame, columns: Sequence[str]) -> list[str]:
    row = df.agg(*exprs(f"max(CAST(`{c}` IS NULL AS INT)) AS `{c}`" for c in columns)).first()
    return [c for c in columns if row[c]]


def missing_flag(column: str) -> str:
    return f"{column}__missing"


def feature_of(name: str) -> str:
    """The feature that an input or its indicator belongs to."""
    return name.removesuffix("__missing")


def filled_texts(features: Sequence[str], with_nulls: Sequence[str]) -> dict[str, str]:
    """Each feature as a number, 0 where missing, and an indicator where training had gaps."""
    gaps = set(with_nulls)
    out = {}
    for c in features:
        out[c] = f"coalesce(CAST(`{c}` AS DOUBLE), 0.0D)"
        if c in gaps:
            out[missing_flag(c)] = f"CAST(`{c}` IS NULL AS DOUBLE)"
    return out


def filled_features(features: Sequence[str], with_nulls: Sequence[str]) -> list[Column]:
    return exprs(f"{text} AS `{n}`" for n, text in filled_texts(features, with_nulls).items())


def input_names(features: Sequence[str], with_nulls: Sequence[str]) -> list[str]:
    gaps = set(with_nulls)
    return [n for c in features for n in ([c, missing_flag(c)] if c in gaps else [c])]


