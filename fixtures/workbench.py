"""Written tables shared by the registered queries.

A query asks for the tables it needs; each is built once per application and
kept as parquet in the folder the cluster names for checkpoints, so later
queries scan it as a warehouse query would, and a lost executor loses nothing.
"""

from __future__ import annotations

import hashlib
import tempfile
from collections.abc import Callable, Iterable, Iterator, Mapping
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime
from threading import RLock

from pyspark.sql import DataFrame, SparkSession

from fixtures.adapter import BRANCH_LIMIT, CALENDAR, RUN_DATE, VIEWS, staging_view
from ledgermill.operators import dimensions, facts, marts
from ledgermill.operators.keys import load_keys
from ledgermill.plans.pipeline import Settings
from ledgermill.schemas import DIMENSIONS, MARTS, STAGING

RUN_TS = datetime(RUN_DATE.year, RUN_DATE.month, RUN_DATE.day)

_benches: dict[tuple[str, str], "Workbench"] = {}
_lock = RLock()


def shared_folder(spark: SparkSession) -> str:
    """The session's checkpoint folder; a temporary one only in local mode."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    context = spark.sparkContext
    if context.getCheckpointDir():
        return context.getCheckpointDir()
    if not context.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder all executors share")
    folder = tempfile.mkdtemp(prefix="ledgermill-")
    context.setCheckpointDir(folder)
    return folder


class Tables(Mapping[str, DataFrame]):
    """Tables by name, each written when it is first asked for.

    A check that reads one dimension need not wait for facts and marts nobody reads.
    """

    def __init__(self, makers: dict[str, Callable[[], DataFrame]]):
        self._makers = makers

    def __getitem__(self, name: str) -> DataFrame:
        return self._makers[name]()

    def __iter__(self) -> Iterator[str]:
        return iter(self._makers)

    def __len__(self) -> int:
        return len(self._makers)

    def __contains__(self, name: object) -> bool:
        return name in self._makers

    def __or__(self, other: Mapping[str, DataFrame]) -> Tables:
        more = other._makers if isinstance(other, Tables) else {n: lambda rows=rows: rows for n, rows in other.items()}
        return Tables(self._makers | more)


class Workbench:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        app = spark.sparkContext.applicationId
        tag = hashlib.md5(self.sf_dir.encode()).hexdigest()[:10]
        self.root = f"{shared_folder(spark)}/ledgermill/{app}/{tag}"
        self._schemas: dict[str, object] = {}
        self._done: set[str] = set()
        self._lock = RLock()
        self._locks: dict[str, RLock] = {}

    def settings(self, **changes) -> Settings:
        plan = {
            "run_ts": RUN_TS,
            "calendar_start": CALENDAR[0],
            "calendar_end": CALENDAR[1],
            "on_duplicate": "keep_first",
            "branch_limit": BRANCH_LIMIT,
            "partition_facts": False,
        }
        return Settings(**(plan | changes))

    def source(self, table: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{table}.parquet")

    def named(self, *names: str) -> Tables:
        return Tables({n: lambda n=n: self[n] for n in names})

    def staging(self) -> Tables:
        return self.named(*(f"stg_{t}" for t in STAGING))

    def plain_staging(self) -> dict[str, DataFrame]:
        return {t: self[f"stg_{t}"] for t in STAGING}

    def dims(self) -> Tables:
        return self.named(*DIMENSIONS, "dim_date")

    def warehouse(self) -> Tables:
        return self.dims() | self.named("fact_transactions", "fact_loans")

    def marts(self) -> Tables:
        return self.named(*MARTS)

    def lock(self, name: str) -> RLock:
        """A table's own lock: a table waits only for those it is built from, so others may be written meanwhile."""
        with self._lock:
            return self._locks.setdefault(name, RLock())

    def side_by_side(self, *lines: Iterable[str]) -> None:
        """Write tables that don't need one another at the same time, each line in its order, so short jobs fill idle cores."""
        with ThreadPoolExecutor(len(lines)) as pool:
            for job in [pool.submit(lambda line=line: [self[name] for name in line]) for line in lines]:
                job.result()

    def once(self, name: str, work: Callable[[str], None]) -> str:
        """Run a job that writes a folder once, and return the folder."""
        folder = f"{self.root}/{name}"
        with self.lock(name):
            if name not in self._done:
                work(folder)
                self._done.add(name)
        return folder

    def stored(self, name: str, rows: Callable[[], DataFrame]) -> DataFrame:
        """Write a table once and return it as stored."""
        with self.lock(name):
            if name not in self._schemas:
                built = rows()
                built.write.mode("overwrite").parquet(f"{self.root}/{name}")
                self._schemas[name] = built.schema
            return self.spark.read.schema(self._schemas[name]).parquet(f"{self.root}/{name}")

    def __getitem__(self, name: str) -> DataFrame:
        return self.stored(name, lambda: self.build(name))

    def read_once(self, name: str) -> DataFrame:
        """A table for a single reader: as stored if a query wrote it, else its plan, so nothing is written to be read once."""
        with self.lock(name):
            return self[name] if name in self._schemas else self.build(name)

    def build(self, name: str) -> DataFrame:
        """The lazy plan of a table over the stored tables below it."""
        if name in VIEWS:
            return staging_view(self.spark, self.sf_dir, name)
        if name in DIMENSIONS:
            stg = self[f"stg_{DIMENSIONS[name].source}"]
            return dimensions.build_dimension(name, stg, RUN_DATE, on_duplicate="keep_first")
        if name == "dim_date":
            return dimensions.build_dim_date(self.spark, *CALENDAR)
        if name == "account_keys":
            return facts.account_keys(
                self["stg_accounts"], self["stg_cards"], self["dim_customer"], self["dim_account"], self["dim_card"]
            )
        if name == "fact_transactions":
            self.side_by_side(["dim_customer"], ["dim_account"], ["dim_card"], ["dim_merchant", "dim_branch", "dim_date"], ["stg_transactions"])
            return load_keys(self.transactions(), "transaction_key")
        if name == "fact_loans":
            return load_keys(self.loans(), "loan_key")
        return self.mart(name)

    def transactions(self, stg: DataFrame | None = None) -> DataFrame:
        rows = self["stg_transactions"] if stg is None else stg
        return facts.build_transactions(rows, self["account_keys"], self.dims())

    def loans(self) -> DataFrame:
        return facts.build_loans(self["stg_loans"], self.dims())

    def mart(self, name: str) -> DataFrame:
        if name == "customer_360":
            return marts.customer_360(
                self["dim_customer"],
                self["dim_account"],
                self["stg_accounts"],
                self["fact_transactions"],
                self["fact_loans"],
            )
        if name == "daily_branch_performance":
            return marts.daily_branch_performance(
                self["dim_date"], self["dim_branch"], self["fact_transactions"], BRANCH_LIMIT
            )
        if name == "merchant_analytics":
            return marts.merchant_analytics(self["dim_merchant"], self["fact_transactions"])
        if name == "credit_risk_monitoring":
            return marts.credit_risk_monitoring(self["fact_loans"], self["dim_customer"])
        raise KeyError(name)


def workbench(spark: SparkSession, sf_dir: str) -> Workbench:
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"))
    with _lock:
        if key not in _benches:
            _benches[key] = Workbench(spark, sf_dir)
        return _benches[key]
