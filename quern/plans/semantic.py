"""Semantic relations, query templates and measures over a star of observations, as functions of tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.operators import aggregates as agg
from quern.operators.quality import bounded, param_filter, validate_params
from quern.operators.reshape import pivot_metrics, row_ratio

#: Codes of the source metrics, and the columns they become. Fixed values.
PRODUCTION = {"5312": "area_ha", "5510": "production_t", "5412": "reported_yield_kg_ha"}
BALANCE = {
    "5016": "loss_t", "5023": "processed_t", "5071": "stock_variation_t", "5113": "opening_stocks_t", "5141": "food_supply_quantity_t", "5165": "other_uses_t",
    "5166": "residuals_t", "5510": "production_t", "5520": "feed_t", "5525": "seed_t", "5610": "import_quantity_t", "5910": "export_quantity_t",
}
TRADE = {"5610": "import_quantity_t", "5622": "import_value_usd", "5910": "export_quantity_t", "5922": "export_value_usd"}


def production_yield(fact: DataFrame, keys: list[str], metric: str = "metric", value: str = "value", names: dict[str, str] = PRODUCTION) -> DataFrame:
    """Area, production and reported yield side by side, and the yield computed from the first two where both are there
    and the area is positive. names: codes of area, production and yield, in this order."""
    area, production, _ = names.values()
    wide = pivot_metrics(fact, keys, metric, value, names)
    return wide.withColumn("computed_yield_kg_ha", row_ratio(F.col(production), F.col(area), 1000))


def supported_balance(fact: DataFrame, keys: list[str], metric: str = "metric", value: str = "value", names: dict[str, str] = BALANCE) -> DataFrame:
    return pivot_metrics(fact, keys, metric, value, names)


def reported_unit_values(fact: DataFrame, keys: list[str], metric: str = "metric", value: str = "value", names: dict[str, str] = TRADE) -> DataFrame:
    """Import and export quantities and values, and their unit values where the quantity is positive; names in the order
    of import quantity, import value, export quantity, export value."""
    iq, iv, eq, ev = names.values()
    wide = pivot_metrics(fact, keys, metric, value, names)
    return wide.withColumns({"import_unit_value": row_ratio(F.col(iv), F.col(iq)), "export_unit_value": row_ratio(F.col(ev), F.col(eq))})


def source_observations(fact: DataFrame, geography: DataFrame, key: str) -> DataFrame:
    return fact.join(geography, key)


#: Template -> parameters it takes: type, least, most.
PARAMS = {"year_from": (int, 1900, 2100), "year_to": (int, 1900, 2100), "product": (str,), "geography": (str,), "metric": (str,)}
COLUMNS = {"year_from": ("year", ">="), "year_to": ("year", "<="), "product": ("product", "="), "geography": ("geography", "="), "metric": ("metric", "=")}


class Templates:
    """Named query templates over one observation table (year, geography, product, metric, unit, value, source, scope;
    for trade partner, for prices reference_period). Parameters are checked against an allow list and filter the fact
    below every join and aggregation.

    dims: tables by name, geography (geography, geography_label, level), product (product, product_label), metric (metric,
    metric_code, metric_unit) and source (source, source_label), one row per key; a template joins those that it shows and
    that are given. roles: metric codes in the order of semantic relations, by template."""

    def __init__(self, fact: DataFrame, most: int = 5000, dims: dict[str, DataFrame] | None = None, roles: dict[str, dict[str, str]] | None = None):
        self.fact, self.most, self.dims = fact, most, dims or {}
        self.roles = {"fao_production": PRODUCTION, "sua": BALANCE, "trade": TRADE} | (roles or {})

    def _filtered(self, params: dict) -> DataFrame:
        return self.fact.filter(param_filter(validate_params(params, PARAMS), COLUMNS))

    def _with(self, f: DataFrame, *names: str) -> DataFrame:
        """f joined with the dimensions of these names; rows without a member go, as facts have one."""
        for name in names:
            if name in self.dims:
                f = f.join(self.dims[name], name)
        return f

    def _shown(self, *names: str) -> list[str]:
        return [c for name in names if name in self.dims for c in self.dims[name].columns if c != name]

    def run(self, name: str, **params) -> DataFrame:
        if name not in self.NAMES:
            raise LookupError(f"there is no template {name}")
        return bounded(getattr(self, name)(self._filtered(params)), self.most)

    def catalogue(self, f):
        return agg.catalogue(f, ["source", "geography", "product", "metric", "unit"], "value", "year")

    def fact_overview(self, f):
        return agg.coverage(f, "value", "year")

    def period_coverage(self, f):
        return agg.period_coverage(f, "value", "year").orderBy("year")

    def nso_catalogue(self, f):
        """What there is by source, scope and level, and for how many places."""
        keys = ["source", "scope", "metric", *(["level"] if "geography" in self.dims else []), "unit"]
        g = self._with(f, "geography").groupBy(*keys)
        return g.agg(*_span("year"), F.count_distinct("geography").alias("geographies")).orderBy(*keys)

    def nso_scope_catalogue(self, f):
        keys = ["geography", *self._shown("geography"), "source", "scope", "metric", "unit"]
        return self._with(f, "geography").groupBy(*keys).agg(*_span("year")).orderBy(*keys)

    def nso_observations(self, f):
        return self._with(f, "geography").orderBy("geography", "metric", "product", "year")

    def fao_production(self, f):
        """Area, production and yield of each place and product, with their labels."""
        wide = production_yield(f, ["geography", "product", "year"], names=self.roles["fao_production"])
        return self._with(wide, "geography", "product").orderBy("geography", "product", "year")

    def sua(self, f):
        return supported_balance(f, ["geography", "product", "year"], names=self.roles["sua"]).orderBy("year", "geography", "product")

    def psd(self, f):
        """Observations with their metric's own code and unit."""
        shown = self._shown("metric") or ["unit"]
        return self._with(f, "metric").select("year", "geography", "product", "metric", *shown, "value", F.when(F.col("value").isNull(), "source_null").alias("missing_reason")).orderBy("metric", "year", "geography", "product")

    def price_observations(self, f):
        reference = F.col("reference_period") if "reference_period" in f.columns else F.lit(None).cast("int").alias("reference_period")
        return self._with(f, "product").select(F.col("year").alias("period"), reference, "product", *self._shown("product"), "unit", "value", F.when(F.col("value").isNull(), "source_null").alias("missing_reason")).orderBy("period", "product")

    def price_coverage(self, f):
        keys = ["product", *self._shown("product"), "unit"]
        g = self._with(f, "product").groupBy(*keys)
        return g.agg(F.min("year").alias("first_period"), F.max("year").alias("last_period"), F.count("*").alias("observations"), F.count("value").alias("numeric_observations"), F.count_distinct("year").alias("represented_periods")).orderBy(F.desc("observations"), "product")

    def trade(self, f):
        """Quantities, values and unit values by partner, with what was present, and the partner's labels."""
        place = "partner" if "partner" in f.columns else "geography"
        keys = list(dict.fromkeys(["geography", place, "product", "year"]))
        wide = reported_unit_values(f, keys, names=self.roles["trade"])
        if "geography" in self.dims:
            wide = wide.join(self.dims["geography"].toDF(*(place if c == "geography" else f"partner_{c}" for c in self.dims["geography"].columns)), place)
        return wide.orderBy("year", *keys[:-1])

    def context_profile(self, f):
        keys = ["source", *self._shown("source"), "scope"]
        return agg.category_profile(self._with(f, "source"), keys).orderBy(*keys)

    def subject_products(self, f):
        made = agg.subject_products(f, "product", "value", "year", "metric")
        return self._with(made, "product").orderBy("product")

    NAMES = ("catalogue", "fact_overview", "period_coverage", "nso_catalogue", "nso_observations", "nso_scope_catalogue", "fao_production", "sua", "psd", "price_observations", "price_coverage", "trade", "context_profile", "subject_products")


def _span(period: str) -> list:
    return [F.min(period).alias("first_year"), F.max(period).alias("last_year"), F.count("*").alias("observations"), F.count("value").alias("numeric_observations")]


def publications(batches: DataFrame) -> DataFrame:
    """Published table versions, newest first."""
    return batches.groupBy("table").agg(F.max("version").alias("version")).orderBy("table")
