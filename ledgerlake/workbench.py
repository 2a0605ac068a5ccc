"""One folder of input tables, taken through all layers; each layer is written when first used."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from datetime import timedelta
from functools import cached_property, partial
from hashlib import sha256

from pyspark.sql import DataFrame, SparkSession

from ledgerlake.analytics import churn, propensity
from ledgerlake.operators import cleaning
from ledgerlake.operators.contracts import validate_sources
from ledgerlake.operators.groups import hot_groups
from ledgerlake.plans import conform, gold, marts
from ledgerlake.plans.lake import IngestionSummary, Lake
from ledgerlake.plans.sheet import writer
from ledgerlake.schemas import SOURCE_ROW, SOURCE_TABLES, SourceTables
from ledgerlake.session import apply_runtime_conf, fit_to_input, stored, work_dir
from ledgerlake.sources import shop_tables

LOAD_ID = "load-0001"
MARTS = ("mart_executive", "mart_customer_360", "mart_cohort_base", "mart_basket_base", "mart_forecasting_base")
DIMENSIONS = ("dim_customer", "dim_product", "dim_channel", "dim_geography", "dim_promotion", "dim_payment_method")
_open: dict[tuple[str, str], Workbench] = {}


class _Models(Mapping):
    """Tables by name, each made when first asked for."""

    def __init__(self, builds: dict[str, Callable[[], DataFrame]]):
        self._builds, self._made = builds, {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._made:
            self._made[name] = self._builds[name]()
        return self._made[name]

    def __iter__(self):
        return iter(self._builds)

    def __len__(self) -> int:
        return len(self._builds)


class Workbench:
    def __init__(self, spark: SparkSession, folder: str, root: str):
        self.spark = spark
        self.folder = folder
        self.root = root
        self.lake = Lake(spark, f"{root}/lake")
        self._marts: dict[str, DataFrame] = {}

    @classmethod
    def of(cls, spark: SparkSession, folder: str) -> Workbench:
        """The workbench of this application and folder; its written tables are reused."""
        apply_runtime_conf(spark)
        application = spark.sparkContext.applicationId
        key = (application, folder)
        if key not in _open:
            name = sha256(folder.encode()).hexdigest()[:12]
            fit_to_input(spark, folder)
            _open[key] = cls(spark, folder, f"{work_dir(spark)}/ledgerlake/{application}/{name}")
        return _open[key]

    # --- layered tables --------------------------------------------------------------------------

    @cached_property
    def batch(self) -> SourceTables:
        """The seven source tables as delivered. Projections of an input table stay plans, whose rows bronze writes once; the two that sum up
        all orders in a few rows are written."""
        derived = shop_tables.shop_batch(self.spark, self.folder)
        return derived.replace(**{t: stored(derived[t]) for t in ("promotions", "calendar_events")})

    @cached_property
    def closed_batch(self) -> SourceTables:
        return shop_tables.closed_batch(self.batch)

    @cached_property
    def damaged(self) -> Workbench:
        """Another lake, loaded from the same batch with defects."""
        other = Workbench(self.spark, self.folder, f"{self.root}/damaged")
        other.batch = shop_tables.damaged_batch(self.batch)
        return other

    @cached_property
    def load(self) -> IngestionSummary:
        return self.lake.ingest(self.batch, validate_sources(self.batch, LOAD_ID), LOAD_ID)

    @property
    def load_id(self) -> str:
        return self.load.load_id

    def staged(self, table: str) -> DataFrame:
        return self.lake.staged(table, self.load_id)

    @cached_property
    def silver(self) -> dict[str, DataFrame]:
        return self.lake.build_silver(self.load_id)

    @cached_property
    def gold(self) -> dict[str, DataFrame]:
        """The calendar and both facts."""
        return self.lake.build_facts(self.load_id, self.silver)

    @cached_property
    def outcomes(self) -> DataFrame:
        return self.lake.build_outcomes(self.load_id, self.gold)

    @cached_property
    def _fact_plans(self) -> dict[str, DataFrame]:
        return self.lake.fact_plans(self.load_id, self.silver)

    def facts_read(self) -> dict[str, DataFrame]:
        """The calendar and both facts for readers of few columns: as written where they are written already, else as plans."""
        return self.gold if "gold" in self.__dict__ else self._fact_plans

    def outcomes_read(self) -> DataFrame:
        """Order totals, likewise."""
        if "outcomes" in self.__dict__:
            return self.outcomes
        facts = self.facts_read()
        return marts.order_outcomes(facts["fact_sales"], facts["fact_returns"], facts["dim_date"])

    def purchase_months(self) -> DataFrame:
        """What retention reads of ``mart_cohort_base``."""
        return marts.purchase_months(self.outcomes_read())

    def conformed(self, table: str) -> DataFrame:
        """The plan of a silver model over its written parents."""
        needed = {"orders", "order_items", "returns"}
        return self.lake.conformed(table, self.load_id, self.silver if table in needed else {})

    def rejected(self) -> DataFrame:
        staged = {t: self.staged(t) for t in conform.CONFORMED_TABLES}
        fallen = {t: self.lake.fallen(t, self.load_id, self.silver) for t in conform.CHILDREN}
        return conform.int_rejected_records(staged, self.lake.failures(self.load_id), self.silver, fallen)

    def _saved(self, area: str, plans: dict[str, DataFrame]) -> dict[str, DataFrame]:
        return {name: self.lake.save(area, name, self.load_id, plan) for name, plan in plans.items()}

    @cached_property
    def dimensions(self) -> dict[str, DataFrame]:
        """The dimensions beside the calendar, written."""
        s = self.silver
        return self._saved(
            "gold",
            {
                "dim_customer": gold.dim_customer(s["customers"]),
                "dim_product": gold.dim_product(s["products"]),
                "dim_channel": gold.dim_channel(s["orders"]),
                "dim_geography": gold.dim_geography(s["customers"]),
                "dim_promotion": gold.dim_promotion(s["promotions"]),
                "dim_payment_method": gold.dim_payment_method(s["orders"]),
            },
        )

    def written_mart(self, name: str) -> DataFrame:
        """A mart as consumers read it, written when first asked for."""
        if name not in self._marts:
            self._marts |= self._saved("gold", {name: self.mart(name)})
        return self._marts[name]

    @property
    def written_marts(self) -> dict[str, DataFrame]:
        """All marts. Tests read these too and build nothing again."""
        return {name: self.written_mart(name) for name in MARTS}

    @cached_property
    def written_rejected(self) -> DataFrame:
        return self._saved("silver", {"int_rejected_records": self.rejected()})["int_rejected_records"]

    def models(self) -> Mapping[str, DataFrame]:
        """Every model of every layer by name, made when it is asked for: a test builds the models it tests."""
        found = {f"stg_{t}": partial(self.staged, t) for t in SOURCE_TABLES}
        found |= {f"int_{t}": partial(lambda t: self.silver[t], t) for t in conform.CONFORMED_TABLES}
        found["int_promotion_assignments"] = lambda: conform.int_promotion_assignments(self.silver["orders"], self.silver["promotions"])
        found["int_rejected_records"] = lambda: self.written_rejected
        found |= {name: partial(lambda name: self.gold[name], name) for name in ("dim_date", "fact_sales", "fact_returns")}
        found |= {name: partial(lambda name: self.dimensions[name], name) for name in DIMENSIONS}
        return _Models(found | {name: partial(self.written_mart, name) for name in MARTS})

    def mart(self, name: str) -> DataFrame:
        """The plan of a mart over what it needs, and no more."""
        if name == "mart_executive":
            facts = self.facts_read()
            return marts.mart_executive(facts["fact_sales"], facts["fact_returns"])
        s = self.silver
        if name == "mart_customer_360":
            return marts.mart_customer_360(gold.dim_customer(s["customers"]), self.outcomes)
        if name == "mart_cohort_base":
            return marts.mart_cohort_base(self.outcomes)
        g = self.facts_read()
        build = {"mart_basket_base": marts.mart_basket_base, "mart_forecasting_base": marts.mart_forecasting_base}[name]
        return build(g["fact_sales"], g["fact_returns"], g["dim_date"], gold.dim_product(s["products"]))

    # --- analyses ----------------------------------------------------------------------------------

    @property
    def analysis_date(self):
        """The day after the last one of the batch."""
        return self.batch.end_date + timedelta(days=1)

    def _event_sources(self) -> tuple[DataFrame, DataFrame]:
        """Order totals and returns. Both are read twice: where they are not written already, the columns of events are."""
        if "outcomes" in self.__dict__:
            return self.outcomes, self.gold["fact_returns"]
        facts = self.facts_read()
        returned = facts["fact_returns"].select(*churn.RETURN_COLUMNS)
        if "gold" not in self.__dict__:
            returned = stored(returned)
        orders = marts.order_outcomes(facts["fact_sales"], returned, facts["dim_date"], returned=())
        return stored(orders.select(*churn.ORDER_COLUMNS)), returned

    @cached_property
    def snapshots(self) -> DataFrame:
        """Customer snapshots at the ends of quarters, from the end of the first year on, written."""
        first = self.batch.start_date + timedelta(days=365)
        cutoffs = churn.quarter_ends(first, self.batch.end_date)
        events = churn.customer_events(*self._event_sources())
        plan = churn.build_customer_snapshots(events, cutoffs, churn.HORIZON_DAYS, self.batch.end_date)
        return self._saved("gold", {"customer_snapshots": plan})["customer_snapshots"]

    @cached_property
    def time_split(self) -> propensity.TimeSplit:
        """Test snapshots are those of the last two years."""
        first_test = self.batch.end_date - timedelta(days=730)
        return propensity.split_by_time(self.snapshots, first_test, churn.HORIZON_DAYS)

    # --- flat sheet --------------------------------------------------------------------------------

    def _sheet_table(self, df: DataFrame, name: str) -> DataFrame:
        return writer(self.spark, f"{self.root}/sheet")(df, name)

    @cached_property
    def sheet(self) -> DataFrame:
        """The raw sheet, written once as the source of the flat pipeline."""
        return self._sheet_table(shop_tables.flat_sheet(self.spark, self.folder), "raw")

    @cached_property
    def rules(self) -> cleaning.CleaningRules:
        categories = shop_tables.approved_categories(self.spark, self.folder)
        first, last = shop_tables.FLAT_YEARS
        return cleaning.CleaningRules(
            categories=self._sheet_table(categories, "categories"), first_year=first, last_year=last
        )

    @cached_property
    def parsed(self) -> DataFrame:
        return self._sheet_table(cleaning.parsed_sheet(self.sheet, self.rules), "parsed")

    @cached_property
    def medians(self) -> DataFrame:
        return self._sheet_table(cleaning.price_medians(self.parsed), "medians")

    def judging_plan(self) -> DataFrame:
        hot = hot_groups(self.sheet, "Order_ID", SOURCE_ROW, self.rules.hot_rows)
        return cleaning.judge_rows(self.parsed, hot, self.medians, self.rules)

    @cached_property
    def judged(self) -> DataFrame:
        return self._sheet_table(self.judging_plan(), "judged")

    @cached_property
    def cleaned(self) -> DataFrame:
        return cleaning.cleaned_rows(self.judged)

    def cleaned_read(self) -> DataFrame:
        """The cleaned sheet for one reader: as written where it is written already, else as a plan."""
        return self.cleaned if "judged" in self.__dict__ else cleaning.cleaned_rows(self.judging_plan())
