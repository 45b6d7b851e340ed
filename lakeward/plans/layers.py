"""The medallion layers over one folder of test tables."""

from __future__ import annotations

import uuid
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeward.operators import anomaly, audit
from lakeward.operators.rollup import dq_rollup
from lakeward.operators.rules import QUARANTINE
from lakeward.plans import entities as ent
from lakeward.plans import shapes, star
from lakeward.session import tune
from lakeward.sources import snapshots
from lakeward.sources.tables import shared_folder

AS_OF = "2003-01-01"
RUN_TS = "2024-01-31 00:00:00"

DIMENSIONS = {
    "customers": star.dim_customers,
    "policy": star.dim_policy,
    "cars": star.dim_cars,
}

# Where silver tables were written, per application and source folder.
_STORES: dict[tuple[str, str], dict[str, str]] = {}


class Layers:
    """Raw and cleaned frames are lazy plans; silver tables are written once and then read.

    A silver table serves several later steps (reference checks, lookups, dimensions,
    facts), so it is stored in the shared folder as parquet instead of being computed
    inside each of them; lineage ends there too.  Dimensions are versions by load.
    """

    def __init__(self, spark: SparkSession, sf_dir: str, fresh: bool = False):
        self.spark, self.sf_dir = tune(spark), sf_dir
        store_key = (spark.sparkContext.applicationId, sf_dir)
        self.stored = {} if fresh else _STORES.setdefault(store_key, {})

    def table(self, name: str) -> DataFrame:
        return shapes.table(self.spark, self.sf_dir, name)

    def raw(self, name: str) -> DataFrame:
        return getattr(shapes, f"raw_{name}")(self.spark, self.sf_dir)

    def cleaned(self, name: str) -> DataFrame:
        return ent.ENTITIES[name].clean(self.raw(name))

    def refs(self, name: str) -> dict[str, DataFrame]:
        return {r.table: self.silver(r.table) for r in ent.ENTITIES[name].references}

    def checked(self, name: str) -> DataFrame:
        return ent.checked(ent.ENTITIES[name], self.raw(name), self.refs(name))

    def stamped(self, rows: DataFrame) -> DataFrame:
        """Rows of a silver or quarantine table with the time of their load."""
        return rows.withColumn(star.LOADED, F.lit(RUN_TS).cast("timestamp"))

    def finished(self, name: str, rows: DataFrame) -> DataFrame:
        """Valid rows as silver has them: a policy also has its age."""
        rows = ent.with_policy_age(rows, AS_OF) if name == "policy" else rows
        return self.stamped(rows)

    def valid(self, name: str) -> DataFrame:
        rows = ent.valid(ent.ENTITIES[name], self.raw(name), self.refs(name))
        return self.finished(name, rows)

    def quarantined(self, name: str) -> DataFrame:
        rows = ent.quarantined(ent.ENTITIES[name], self.raw(name), self.refs(name))
        return self.stamped(rows)

    def _store(self, name: str, write) -> str:
        """The folder of a stored table; ``write`` fills it once."""
        if name not in self.stored:
            path = f"{shared_folder(self.spark)}/{name}-{uuid.uuid4().hex}"
            write(path)
            self.stored[name] = path
        return self.stored[name]

    def routed(self, name: str) -> DataFrame:
        """Both sides of an entity, stored by one pass over its raw rows."""

        def write(path: str) -> None:
            rows = ent.routed(ent.ENTITIES[name], self.raw(name), self.refs(name))
            rows.write.partitionBy("_route").parquet(path)

        return self.spark.read.parquet(self._store(f"routed-{name}", write))

    def silver(self, name: str) -> DataFrame:
        """The stored valid rows of an entity, after those of the entities it refers to."""

        def write(path: str) -> None:
            rows = ent.unique(ent.ENTITIES[name], self.routed(name))
            self.finished(name, rows).write.parquet(path)

        return self.spark.read.parquet(self._store(name, write))

    def quarantine(self, name: str) -> DataFrame:
        """The stored quarantined rows of an entity; the valid side is not read."""
        entity = ent.ENTITIES[name]
        rows = self.routed(name).where(F.col("_route") == QUARANTINE)
        return self.stamped(
            rows.select(*entity.quarantine_columns, "error_reason", "error_reasons")
        )

    def load_dimension(self, name: str, rows: DataFrame, load: int) -> DataFrame:
        """The dimension after ``load`` has added ``rows`` to the version before it.

        A load that is repeated starts from the same version and publishes the same rows.
        """
        path = self._store(f"dim-{name}", lambda path: None)
        previous = snapshots.current(self.spark, path, before=load)
        snapshots.publish(DIMENSIONS[name](rows, previous), path, load)
        return snapshots.current(self.spark, path)

    def dimension(self, name: str) -> DataFrame:
        """The current version of a dimension; the first load is the silver table."""
        path = self.stored.get(f"dim-{name}")
        found = snapshots.current(self.spark, path) if path else None
        return self.load_dimension(name, self.silver(name), 1) if found is None else found

    @cached_property
    def dim_customers(self) -> DataFrame:
        return self.dimension("customers")

    @cached_property
    def dim_policy(self) -> DataFrame:
        return self.dimension("policy")

    @cached_property
    def dim_cars(self) -> DataFrame:
        return self.dimension("cars")

    @cached_property
    def fact_claims(self) -> DataFrame:
        return star.fact_claims(self.silver("claims"), self.silver("policy"))

    @cached_property
    def fact_sales(self) -> DataFrame:
        return star.fact_sales(self.silver("sales"), self.silver("policy"), AS_OF)

    @cached_property
    def scored(self) -> DataFrame:
        return anomaly.score_claims(self.silver("claims"))

    @cached_property
    def issues(self) -> DataFrame:
        return dq_rollup({name: self.quarantine(name) for name in ent.ENTITIES})

    @cached_property
    def audit(self) -> DataFrame:
        log = shapes.event_log(self.spark, self.sf_dir)
        return audit.audit_metrics(log, F.lit(RUN_TS).cast("timestamp"))
