"""Row-wise feature expressions.

Pure projections: no fit, no shuffle.  The builder takes a spec naming the
columns so the same code serves the house table and the analogue tables.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from .clean import fill_token, to_number


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def floor0(x) -> Column:
    """Clip below at 0 keeping null (``greatest`` would turn null into 0)."""
    x = _c(x)
    return F.when(x < 0, F.lit(0)).otherwise(x)


def age(later, earlier) -> Column:
    """Later - earlier, floored at 0; null stays null."""
    return floor0(_c(later) - _c(earlier))


def sum_nullprop(cols: Sequence, weights: Sequence[float] | None = None) -> Column:
    """P10: weighted sum, null if any term is null."""
    weights = weights or [1.0] * len(cols)
    terms = [_c(c) if w == 1.0 else _c(c) * F.lit(w) for c, w in zip(cols, weights)]
    out = terms[0]
    for t in terms[1:]:
        out = out + t
    return out


def sum_zero(cols: Sequence, weights: Sequence[float] | None = None) -> Column:
    """Weighted sum with null terms counted as 0."""
    return sum_nullprop([F.coalesce(_c(c), F.lit(0)) for c in cols], weights)


def product(a, b) -> Column:
    """Interaction term."""
    return _c(a) * _c(b)


def presence(c) -> Column:
    """1.0 when the (null -> 0) value is positive, else 0.0."""
    return (F.coalesce(_c(c), F.lit(0)) > 0).cast("double")


def log1p_floor0(c) -> Column:
    """log1p of the value floored at 0, numeric coercion first."""
    return F.log1p(floor0(to_number(_c(c).cast("string"))))


def nominal(c) -> Column:
    """Number -> nominal string (``Int64`` -> string)."""
    return _c(c).cast("bigint").cast("string")


@dataclass(frozen=True)
class FeatureSpec:
    """Names used by the feature builder; every entry is optional."""
    ages: Mapping[str, tuple[str, str]] = field(default_factory=dict)
    sums: Mapping[str, tuple[Sequence[str], Sequence[float] | None]] = field(default_factory=dict)
    products: Mapping[str, tuple[str, str]] = field(default_factory=dict)
    flags: Mapping[str, str] = field(default_factory=dict)
    log_candidates: Sequence[str] = ()
    nominal: Sequence[str] = ()
    drop: Sequence[str] = ()

    def source_columns(self) -> list[str]:
        """Input columns that the derived ones read, in order of first use."""
        used = [c for pair in (*self.ages.values(), *self.products.values()) for c in pair]
        used += [c for cols, _ in self.sums.values() for c in cols]
        used += [*self.flags.values(), *self.log_candidates]
        made = {*self.ages, *self.sums, *self.products, *self.flags}
        return [c for c in dict.fromkeys(used) if c not in made]


def build_features(df: DataFrame, spec: FeatureSpec, enabled: bool = True,
                   add_log_features: bool = True, null_as_zero: bool = False) -> DataFrame:
    """F1 (and the sum form of F12): one select adding the derived columns.

    ``null_as_zero`` switches P10 to P11 (the second feature variant).
    Log columns are added only for candidates present in the frame.
    """
    base = [c for c in df.columns if c not in set(spec.drop)]
    new: list[Column] = []
    if enabled:
        for name, (later, earlier) in spec.ages.items():
            new.append(age(later, earlier).alias(name))
        summer = sum_zero if null_as_zero else sum_nullprop
        for name, (cols, weights) in spec.sums.items():
            new.append(summer(cols, weights).alias(name))
        for name, (a, b) in spec.products.items():
            new.append(product(a, b).alias(name))
        for name, src in spec.flags.items():
            new.append(presence(src).alias(name))
    if add_log_features:
        present = set(df.columns)
        for c in spec.log_candidates:
            if c in present:
                new.append(log1p_floor0(c).alias(f"log1p_{c}"))
    return df.select(*base, *new)


def native_category_features(df: DataFrame, nominal_cols: Iterable[str],
                             token: str = "__MISSING__") -> DataFrame:
    """F12 tail: listed numbers as nominal text, and every text column's null
    replaced by ``token`` (for models that take categories natively)."""
    nominal_cols = set(nominal_cols)
    out = []
    for f in df.schema.fields:
        e = F.col(f.name)
        if f.name in nominal_cols:
            e = fill_token(nominal(e), token)
        elif not isinstance(f.dataType, NumericType) and f.dataType.simpleString() == "string":
            e = fill_token(e, token)
        out.append(e.alias(f.name))
    return df.select(*out)


def numeric_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    """P5: numeric columns by schema type (not by sampling)."""
    exclude = set(exclude)
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, NumericType) and f.name not in exclude]


def categorical_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    exclude = set(exclude)
    return [f.name for f in df.schema.fields
            if f.dataType.simpleString() == "string" and f.name not in exclude]


# The feature spec of the house table (same derived names).
HOUSE_SPEC = FeatureSpec(
    ages={"HouseAge": ("YrSold", "YearBuilt"), "RemodAge": ("YrSold", "YearRemodAdd"),
          "GarageAge": ("YrSold", "GarageYrBlt")},
    sums={"TotalSF": (["TotalBsmtSF", "1stFlrSF", "2ndFlrSF"], None),
          "TotalBathrooms": (["FullBath", "HalfBath", "BsmtFullBath", "BsmtHalfBath"],
                             [1.0, 0.5, 1.0, 0.5]),
          "TotalPorchSF": (["WoodDeckSF", "OpenPorchSF", "EnclosedPorch", "3SsnPorch",
                            "ScreenPorch"], None)},
    products={"QualGrLivInteraction": ("OverallQual", "GrLivArea")},
    flags={"HasGarage": "GarageArea", "HasBasement": "TotalBsmtSF",
           "HasFireplace": "Fireplaces", "HasPool": "PoolArea", "HasSecondFloor": "2ndFlrSF"},
    log_candidates=("LotArea", "LotFrontage", "MasVnrArea", "BsmtFinSF1", "BsmtFinSF2",
                    "BsmtUnfSF", "TotalBsmtSF", "1stFlrSF", "2ndFlrSF", "LowQualFinSF",
                    "GrLivArea", "GarageArea", "WoodDeckSF", "OpenPorchSF", "EnclosedPorch",
                    "3SsnPorch", "ScreenPorch", "PoolArea", "MiscVal"),
    nominal=("MSSubClass", "MoSold"),
    drop=("Id",),
)

# Spec of the order analogue table: same operator kinds over order columns.
ORD_SPEC = FeatureSpec(
    ages={"ship_lag_years": ("l_ship_year", "o_year"),
          "order_before_ship": ("o_year", "l_ship_year")},
    sums={"qty_lines": (["l_qty", "l_n_lines"], [1.0, 0.5]),
          "price_bal": (["l_price", "c_acctbal"], None)},
    products={"qty_disc": ("l_qty", "l_max_disc")},
    flags={"has_lines": "l_n_lines", "has_credit": "c_acctbal"},
    log_candidates=("l_qty", "l_price", "c_acctbal", "l_n_lines", "not_a_column"),
    nominal=("o_month", "n_regionkey"),
)
