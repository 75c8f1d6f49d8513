"""Leakage-free fitted feature transforms.

``fit_*`` reads training rows only and returns a small *parameter table*
``(by..., feature, stat, value)``; ``apply_*`` turns it back into column
expressions.  With ``by=()`` the table is collected (it has a row per feature
and statistic) and inlined as literals, so applying is a pure projection.
With ``by=("fold",)`` one fit per fold is made in the same jobs and attached
with a broadcast equi-join on the fold (k x features rows).

Per-fold training sets are never copied for moments: fold moments are
subtracted from the totals.  Quantiles do not subtract, so for them rows are
expanded to the k-1 folds they train (``expand_training_folds``).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.clean import MISSING_TOKEN
from ..functions.stats import count_true
from ..session import broadcast_limit_rows, materialize
from .quantiles import column_quantiles
from .rank import grouped_row_number

PARAM_SCHEMA = "feature string, stat string, value double"


def _x(c: str) -> Column:
    """Numeric cell as double with NaN turned into null."""
    v = F.col(f"`{c}`").cast("double")
    return F.when(~F.isnan(v), v)


def expand_training_folds(df: DataFrame, fold: str, k: int, out: str = "fit_fold") -> DataFrame:
    """Each row once per fold whose training part contains it (k-1 copies)."""
    others = F.filter(F.sequence(F.lit(0), F.lit(k - 1)), lambda f: f != F.col(fold))
    return df.withColumn(out, F.explode(others)).withColumn(out, F.col(out).cast("int"))


@dataclass
class Params:
    """A fitted parameter table plus how to read it back."""
    table: DataFrame
    by: tuple[str, ...] = ()
    _lit: dict | None = None

    def values(self) -> dict:
        if self._lit is None:
            self._lit = {(r.feature, r.stat): r.value for r in self.table.collect()}
        return self._lit

    def attach(self, df: DataFrame, needed: Sequence[tuple[str, str]]):
        """Return (df', getter) where getter(feature, stat) is a Column."""
        if not self.by:
            vals = self.values()
            return df, lambda f, s: F.lit(vals.get((f, s))).cast("double")
        names = {(f, s): f"__p_{i}" for i, (f, s) in enumerate(needed)}
        wide = self.table.groupBy(*self.by).agg(*[
            F.max(F.when((F.col("feature") == f) & (F.col("stat") == s), F.col("value"))).alias(n)
            for (f, s), n in names.items()])
        # one row per fold: bounded by k
        joined = df.join(F.broadcast(wide), list(self.by), "left")
        return joined, lambda f, s: F.col(names[(f, s)])

    def save(self, path: str) -> None:
        """Parameter tables are plain Parquet."""
        self.table.write.mode("overwrite").parquet(path)

    @staticmethod
    def load(spark, path: str, by: Sequence[str] = ()) -> "Params":
        return Params(spark.read.parquet(path), tuple(by))


def _drop_params(df: DataFrame, before: Sequence[str]) -> DataFrame:
    return df.drop(*[c for c in df.columns if c.startswith("__p_") and c not in before])


def _stat_rows(one: DataFrame, by: Sequence[str], items: Mapping[tuple[str, str], Column]) -> DataFrame:
    """Aggregate named statistics, returned as long parameter rows."""
    names = {k: f"__s{i}" for i, k in enumerate(items)}
    agg = one.groupBy(*by).agg(*[e.cast("double").alias(names[k]) for k, e in items.items()])
    return agg.select(*by, F.explode(F.array(*[
        F.struct(F.lit(f).alias("feature"), F.lit(s).alias("stat"), F.col(n).alias("value"))
        for (f, s), n in names.items()])).alias("_p")).select(*by, "_p.*")


# ------------------------------------------------------------------ F2 winsorise

def fit_winsor(df: DataFrame, cols: Sequence[str], key: str, lower: float = 0.005,
               upper: float = 0.995, by: Sequence[str] = ()) -> Params:
    q = column_quantiles(df, cols, [lower, upper], key, by)
    t = q.select(*by, F.col("column").alias("feature"),
                 F.when(F.col("p") == F.lit(lower), "lower").otherwise("upper").alias("stat"),
                 "value")
    return Params(t, tuple(by))


def winsor_expr(c: str, get) -> Column:
    """Clip into [lower, upper]; a null stays null (least/greatest skip nulls)."""
    x = _x(c)
    return F.when(x.isNotNull(), F.least(F.greatest(x, get(c, "lower")), get(c, "upper")))


def apply_winsor(df: DataFrame, params: Params, cols: Sequence[str]) -> DataFrame:
    before = df.columns
    df2, get = params.attach(df, [(c, s) for c in cols for s in ("lower", "upper")])
    return _drop_params(df2.withColumns({c: winsor_expr(c, get) for c in cols}), before)


# ------------------------------------------------------------------ F3 impute

def fit_median_impute(df: DataFrame, cols: Sequence[str], key: str,
                      by: Sequence[str] = ()) -> Params:
    """Exact median per column plus a flag for columns that had nulls at fit."""
    med = column_quantiles(df, cols, [0.5], key, by).select(
        *by, F.col("column").alias("feature"), F.lit("median").alias("stat"), "value")
    nulls = _stat_rows(df, by, {(c, "had_null"): (count_true(_x(c).isNull()) > 0).cast("double")
                                for c in cols})
    return Params(med.unionByName(nulls), tuple(by))


# ------------------------------------------------------------------ F5 / F6 scale

def fit_standard(df: DataFrame, cols: Sequence[str], by: Sequence[str] = ()) -> Params:
    """Mean and population std; a zero std scales by 1."""
    items = {}
    for c in cols:
        items[(c, "center")] = F.avg(_x(c))
        sd = F.stddev_pop(_x(c))
        items[(c, "scale")] = F.when(sd > 0, sd).otherwise(F.lit(1.0))
    return Params(_stat_rows(df, by, items), tuple(by))


def fit_robust(df: DataFrame, cols: Sequence[str], key: str, by: Sequence[str] = ()) -> Params:
    """Median and IQR; a zero IQR scales by 1."""
    q = column_quantiles(df, cols, [0.25, 0.5, 0.75], key, by)
    w = q.groupBy(*by, "column").agg(
        F.max(F.when(F.col("p") == 0.5, F.col("value"))).alias("center"),
        (F.max(F.when(F.col("p") == 0.75, F.col("value")))
         - F.max(F.when(F.col("p") == 0.25, F.col("value")))).alias("iqr"))
    t = w.select(*by, F.col("column").alias("feature"), F.explode(F.array(
        F.struct(F.lit("center").alias("stat"), F.col("center").alias("value")),
        F.struct(F.lit("scale").alias("stat"),
                 F.when(F.col("iqr") != 0, F.col("iqr")).otherwise(F.lit(1.0)).alias("value"))
    )).alias("_s")).select(*by, "feature", "_s.stat", "_s.value")
    return Params(t, tuple(by))


def apply_scale(df: DataFrame, params: Params, cols: Sequence[str]) -> DataFrame:
    before = df.columns
    df2, get = params.attach(df, [(c, s) for c in cols for s in ("center", "scale")])
    return _drop_params(df2.withColumns(
        {c: (_x(c) - get(c, "center")) / get(c, "scale") for c in cols}), before)


# ------------------------------------------------------------------ numeric pipeline (F2+F3+F5/F6)

@dataclass
class NumericModel:
    cols: list[str]
    winsor: Params | None
    impute: Params
    scale: Params
    indicators: list[str]
    by: tuple[str, ...] = ()

    @property
    def output_cols(self) -> list[str]:
        return self.cols + [f"missingindicator_{c}" for c in self.indicators]


def fit_numeric(df: DataFrame, cols: Sequence[str], key: str, winsorize: bool = False,
                scaler: str = "standard", by: Sequence[str] = ()) -> NumericModel:
    """clip (optional) -> median impute + indicators -> scale, each step fitted
    on the output of the previous one, all on the rows of ``df``."""
    cols, by = list(cols), tuple(by)
    cur = df
    wins = None
    if winsorize:
        wins = fit_winsor(cur, cols, key, by=by)
        cur = apply_winsor(cur, wins, cols)
    imp = fit_median_impute(cur, cols, key, by=by)
    if by:
        # one row per (group, feature, stat): a bounded fetch
        stats = imp.table.filter(((F.col("stat") == "had_null") & (F.col("value") > 0))
                                 | ((F.col("stat") == "median") & F.col("value").isNotNull())) \
            .select("feature", "stat").distinct().collect()
        found = {(r.feature, r.stat) for r in stats}
    else:  # fetched once, for the projections as well
        found = {(f, s) for (f, s), v in imp.values().items() if v is not None and (s == "median" or v > 0)}
    with_nulls = {f for f, s in found if s == "had_null"}
    with_values = {f for f, s in found if s == "median"}
    indicators = [c for c in cols if c in with_nulls]
    # a column without any value at fit is dropped (its indicator is kept)
    cols = [c for c in cols if c in with_values]
    cur = _apply_impute(cur, imp, cols, indicators)
    out_cols = cols + [f"missingindicator_{c}" for c in indicators]
    sc = (fit_robust(cur, out_cols, key, by=by) if scaler == "robust"
          else fit_standard(cur, out_cols, by=by))
    return NumericModel(cols, wins, imp, sc, indicators, by)


def _apply_impute(df: DataFrame, imp: Params, cols: Sequence[str], indicators: Sequence[str]) -> DataFrame:
    before = df.columns
    df2, get = imp.attach(df, [(c, "median") for c in cols])
    exprs = {c: F.coalesce(_x(c), get(c, "median")) for c in cols}
    exprs.update({f"missingindicator_{c}": _x(c).isNull().cast("double") for c in indicators})
    # indicators first: they read the un-imputed values
    ind = {k: v for k, v in exprs.items() if k.startswith("missingindicator_")}
    df2 = df2.withColumns(ind).withColumns({c: exprs[c] for c in cols})
    return _drop_params(df2, before)


def apply_numeric(df: DataFrame, model: NumericModel) -> DataFrame:
    cur = df
    if model.winsor is not None:
        cur = apply_winsor(cur, model.winsor, model.cols)
    cur = _apply_impute(cur, model.impute, model.cols, model.indicators)
    return apply_scale(cur, model.scale, model.output_cols)


# ------------------------------------------------------------------ F7 ordinal

def ordinal_code(c: str, levels: Sequence[str]) -> Column:
    """Position in the given level order (0-based) after the Missing fill;
    unknown -> -1."""
    v = F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(MISSING_TOKEN))
    return (F.array_position(F.array(*[F.lit(x) for x in levels]), v) - 1).cast("double")


def fit_ordinal(df: DataFrame, spec: Mapping[str, Sequence[str]], by: Sequence[str] = ()) -> Params:
    coded = df.select(*by, *[ordinal_code(c, lv).alias(c) for c, lv in spec.items()])
    return fit_standard(coded, list(spec), by)


def apply_ordinal(df: DataFrame, spec: Mapping[str, Sequence[str]], params: Params) -> DataFrame:
    coded = df.withColumns({c: ordinal_code(c, lv) for c, lv in spec.items()})
    return apply_scale(coded, params, list(spec))


# ------------------------------------------------------------------ F8 one-hot with rare grouping

INFREQUENT = "infrequent_sklearn"


def fit_onehot(df: DataFrame, cols: Sequence[str], min_frequency: int | None = None) -> DataFrame:
    """Level dictionary (feature, level, slot): frequent levels in lexical
    order, then one shared slot for levels seen fewer than ``min_frequency``
    times.  One unpivoted group-by for all columns."""
    levels = F.explode(F.array(*[
        F.struct(F.lit(c).alias("feature"),
                 F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(MISSING_TOKEN)).alias("level"))
        for c in cols]))
    counts = (df.select(levels.alias("_l")).groupBy("_l.feature", "_l.level")
              .agg(F.count(F.lit(1)).alias("n")))
    minf = min_frequency or 0
    counts = counts.withColumn("rare", F.col("n") < F.lit(minf))
    # the dictionary stays distributed: a column may have any number of levels
    frequent = grouped_row_number(counts.filter(~F.col("rare")), ["level"], ["feature"], out="_r")
    n_frequent = frequent.groupBy("feature").agg(F.count(F.lit(1)).alias("_nf"))
    rare = counts.filter(F.col("rare")).join(n_frequent, "feature", "left")
    out = frequent.select("feature", "level", (F.col("_r") - 1).cast("int").alias("slot"), "rare") \
        .unionByName(rare.select("feature", "level", F.coalesce("_nf", F.lit(0)).cast("int").alias("slot"),
                                 "rare"))
    return materialize(out)


MAX_DENSE_LEVELS = 10_000


def too_wide(dictionary: DataFrame) -> bool:
    """Whether the levels are too many for a column each."""
    return dictionary.limit(MAX_DENSE_LEVELS + 1).count() > MAX_DENSE_LEVELS


def onehot_columns(df: DataFrame, dictionary: DataFrame) -> tuple[DataFrame, list[str]]:
    """Dense 0/1 column per slot (the assembler stores them sparsely);
    unknown levels give all zeros.  The width is the number of levels, so the
    dictionary is fetched only below ``MAX_DENSE_LEVELS`` rows; past that
    ``FittedPreprocessor.transform`` makes sparse vectors of ``onehot_slots``."""
    rows = dictionary.limit(MAX_DENSE_LEVELS + 1).collect()
    if len(rows) > MAX_DENSE_LEVELS:
        raise ValueError("too many one-hot levels for dense columns; raise min_frequency "
                         "or use onehot_slots")
    slots: dict[str, dict[int, tuple[bool, list[str]]]] = {}
    for r in sorted(rows, key=lambda r: (r.feature, r.slot, r.level)):
        slots.setdefault(r.feature, {}).setdefault(r.slot, (r.rare, []))[1].append(r.level)
    exprs, names = {}, []
    for c, per in slots.items():
        v = F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(MISSING_TOKEN))
        for slot in sorted(per):
            rare, lv = per[slot]
            name = f"{c}_{INFREQUENT}" if rare else f"{c}_{lv[0]}"
            exprs[name] = v.isin(*lv).cast("double")
            names.append(name)
    return df.withColumns(exprs), names


def onehot_slots(df: DataFrame, dictionary: DataFrame, feature: str) -> DataFrame:
    """Category -> slot by a left join with the level dictionary; unseen
    levels get slot -1.  The dictionary has one row per level seen at fit:
    broadcast when it is small (checked), shuffled otherwise."""
    d = dictionary.filter(F.col("feature") == feature).select(
        F.col("level").alias("_level"), "slot")
    n_slots = d.agg(F.max("slot") + 1).first()[0] or 0
    if d.count() <= broadcast_limit_rows(df.sparkSession):
        d = F.broadcast(d)
    v = F.coalesce(F.col(f"`{feature}`").cast("string"), F.lit(MISSING_TOKEN))
    out = df.join(d, v == F.col("_level"), "left").drop("_level")
    return out.withColumn("slot", F.coalesce("slot", F.lit(-1))).withColumn(
        "n_slots", F.lit(n_slots))


def fold_complement_standard(df: DataFrame, cols: Sequence[str], fold: str, k: int) -> DataFrame:
    """F11 for moments: per-fold training mean and population std from one
    aggregation by fold (totals - fold), after centring on the global mean."""
    center = df.agg(*[F.avg(c).alias(c) for c in cols]).first().asDict()
    aggs = [F.count(F.lit(1)).cast("double").alias("n")]
    for c in cols:
        x = F.col(c).cast("double") - F.lit(center[c])
        aggs += [F.sum(x).alias(f"s_{c}"), F.sum(x * x).alias(f"ss_{c}")]
    rows = {r[fold]: r for r in df.groupBy(fold).agg(*aggs).collect()}
    tot = {name: sum(r[name] for r in rows.values()) for name in rows[next(iter(rows))].asDict()
           if name != fold}
    out = []
    for f, r in sorted(rows.items()):
        n = tot["n"] - r["n"]
        for c in cols:
            s = tot[f"s_{c}"] - r[f"s_{c}"]
            ss = tot[f"ss_{c}"] - r[f"ss_{c}"]
            mean = s / n
            var = max(ss / n - mean * mean, 0.0)
            out += [(int(f), c, "center", mean + center[c]),
                    (int(f), c, "scale", var ** 0.5 if var > 0 else 1.0)]
    return df.sparkSession.createDataFrame(out, f"{fold} int, feature string, stat string, value double")


# ------------------------------------------------------------------ F10 target scaler

def fit_target_scaler(df: DataFrame, y: str, mode: str = "standard",
                      by: Sequence[str] = ()) -> Params:
    base = F.log1p(F.col(y)) if mode == "log1p" else F.col(y).cast("double")
    sd = F.stddev_pop(base)
    items = {(y, "center"): F.avg(base), (y, "scale"): F.when(sd > 0, sd).otherwise(F.lit(1.0))}
    return Params(_stat_rows(df, by, items), tuple(by))


def target_forward(y: str, get, mode: str = "standard") -> Column:
    base = F.log1p(F.col(y)) if mode == "log1p" else F.col(y).cast("double")
    return (base - get(y, "center")) / get(y, "scale")


def target_inverse(z, y: str, get, mode: str = "standard") -> Column:
    base = z * get(y, "scale") + get(y, "center")
    v = F.expm1(base) if mode == "log1p" else base
    return F.greatest(v, F.lit(0.0))
