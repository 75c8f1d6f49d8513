"""the column router -- numeric, ordinal and nominal columns each get
their fitted transform, the outputs are concatenated in that order, all
other columns are dropped, and the result is assembled into one vector.

A ``FittedPreprocessor`` is only parameter tables plus column lists, so it
is saved as Parquet and applied as a projection (batch or stream).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.features import FeatureSpec, build_features, numeric_columns
from . import prep as P


@dataclass(frozen=True)
class PreprocessConfig:
    feature_engineering: bool = True
    add_log_features: bool = True
    winsorize: bool = False
    scaler: str = "standard"            # or "robust"
    encoding: str = "onehot"            # "ordinal": listed ordered columns get F7
    min_frequency: int | None = None
    numeric_only: bool = False


@dataclass
class FittedPreprocessor:
    config: PreprocessConfig
    spec: FeatureSpec
    key: str
    numeric: P.NumericModel
    ordinal_levels: Mapping[str, Sequence[str]]
    ordinal: P.Params | None
    dictionary: DataFrame | None
    nominal: list[str] = field(default_factory=list)

    def transform(self, df: DataFrame, vector: str | None = "features", keep: Sequence[str] = ()) -> tuple[DataFrame, list[str]]:
        """Key (and ``keep``), columns and vector, and the names of the vector's parts.  Above ``MAX_DENSE_LEVELS``
        one-hot levels the vector is sparse and a nominal column is one part, ``<column>_onehot``,
        whose positions are the slots of ``dictionary``; there are no columns per level then, so
        ``vector=None`` raises."""
        keep = list(dict.fromkeys([self.key, *[c for c in df.columns if c == "row_index"], *keep]))
        built = build_features(df, self.spec, self.config.feature_engineering,
                               self.config.add_log_features)
        out = P.apply_numeric(built, self.numeric)
        names = list(self.numeric.output_cols)
        if self.ordinal is not None:
            out = P.apply_ordinal(out, self.ordinal_levels, self.ordinal)
            names += list(self.ordinal_levels)
        if self.dictionary is not None and vector and P.too_wide(self.dictionary):
            return self._sparse(out, names, keep, vector)
        if self.dictionary is not None:
            out, oh = P.onehot_columns(out, self.dictionary)
            names += oh
        out = out.select(*keep, *[F.col(f"`{n}`") for n in names])
        if vector:
            from .models import assemble
            out = assemble(out, names, vector)
        return out, names

    def _sparse(self, out: DataFrame, names: list[str], keep: list[str], vector: str) -> tuple[DataFrame, list[str]]:
        """Slots joined per nominal column, encoded as sparse vectors and put behind the other parts."""
        from pyspark.ml.feature import OneHotEncoder, VectorAssembler
        # one row per nominal column
        sizes = {r.feature: r.n for r in self.dictionary.groupBy("feature").agg((F.max("slot") + 1).alias("n")).collect()}
        nominal = [c for c in self.nominal if c in sizes]
        cols = [f"__n{i}" for i in range(len(nominal))]
        cur = out.select(F.struct(*[F.col(f"`{c}`") for c in keep + names]).alias("__row"),
                         *[F.col(f"`{n}`").cast("double").alias(f"__x{i}") for i, n in enumerate(names)],
                         *[F.col(f"`{c}`").alias(n) for c, n in zip(nominal, cols)])
        for c, n in zip(nominal, cols):
            own = self.dictionary.filter(F.col("feature") == c).withColumn("feature", F.lit(n))
            # an unseen level takes the slot past the last one, which the encoder leaves out
            cur = P.onehot_slots(cur, own, n).withColumn(
                f"{n}_slot", F.when(F.col("slot") < 0, F.col("n_slots")).otherwise(F.col("slot")).cast("double")).drop("slot", "n_slots")
        ends = out.sparkSession.createDataFrame([tuple(float(sizes[c] - 1) for c in nominal)],
                                                ", ".join(f"{n}_slot double" for n in cols))
        encoder = OneHotEncoder(inputCols=[f"{n}_slot" for n in cols], outputCols=[f"{n}_vec" for n in cols],
                                handleInvalid="keep", dropLast=True).fit(ends)
        parts = [f"__x{i}" for i in range(len(names))] + [f"{n}_vec" for n in cols]
        wide = VectorAssembler(inputCols=parts, outputCol="__features", handleInvalid="keep").transform(encoder.transform(cur))
        return wide.select("__row.*", F.col("__features").alias(vector)), names + [f"{c}_onehot" for c in nominal]

    def save(self, root: str) -> None:
        """The parameter tables under ``root``."""
        self.numeric.impute.save(f"{root}/impute")
        self.numeric.scale.save(f"{root}/scale")
        if self.numeric.winsor is not None:
            self.numeric.winsor.save(f"{root}/winsor")
        if self.ordinal is not None:
            self.ordinal.save(f"{root}/ordinal")
        if self.dictionary is not None:
            self.dictionary.write.mode("overwrite").parquet(f"{root}/dictionary")


def fit_preprocessor(df: DataFrame, key: str, target: str | None, spec: FeatureSpec,
                     config: PreprocessConfig = PreprocessConfig(),
                     ordinal_levels: Mapping[str, Sequence[str]] | None = None) -> FittedPreprocessor:
    """Fit every step on ``df`` (training rows only)."""
    # the key is carried through (it is never a feature) even if the spec drops it
    spec = replace(spec, drop=tuple(c for c in spec.drop if c != key))
    built = build_features(df, spec, config.feature_engineering, config.add_log_features)
    drop = {key, target} if target else {key}
    drop.add("row_index")
    numeric = [c for c in numeric_columns(built) if c not in drop]
    text = [f.name for f in built.schema.fields
            if f.dataType.simpleString() == "string" and f.name not in drop]
    categorical = [] if config.numeric_only else text
    levels = dict(ordinal_levels or {}) if config.encoding == "ordinal" else {}
    ordinal_cols = [c for c in categorical if c in levels]
    nominal = [c for c in categorical if c not in ordinal_cols]
    num = P.fit_numeric(built, numeric, key, winsorize=config.winsorize, scaler=config.scaler)
    ordp = P.fit_ordinal(built, {c: levels[c] for c in ordinal_cols}) if ordinal_cols else None
    dictionary = P.fit_onehot(built, nominal, config.min_frequency) if nominal else None
    return FittedPreprocessor(config, spec, key, num, {c: levels[c] for c in ordinal_cols},
                              ordp, dictionary, nominal)


def index_categories(df: DataFrame, cols: Sequence[str], suffix: str = "_idx"):
    """F12 for native-category tree models: ``StringIndexer`` with unseen
    levels kept in an extra bucket."""
    from pyspark.ml.feature import StringIndexer
    idx = StringIndexer(inputCols=list(cols), outputCols=[f"{c}{suffix}" for c in cols],
                        handleInvalid="keep", stringOrderType="alphabetAsc")
    return idx.fit(df)
