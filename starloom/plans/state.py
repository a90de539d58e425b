"""Lazily built warehouse states over the stand-in sources (initial load at T0, increments at T1 and T2).

Tables are built on first use. Dimensions, and the archives and dimensions of later days, are written to the shared
checkpoint folder then (``materialize`` runs a job), as a load run would write them: facts, checks and marts that read
one several times scan a small written table instead of deriving it again from the driver tables.
"""

from __future__ import annotations

from collections.abc import Collection
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.operators import archive as A
from starloom.plans import car_service as CS
from starloom.plans import stand_in as SI
from starloom.plans.loads import together
from starloom.session import FAR_FUTURE, ts_lit
from starloom.sources.store import materialize


class Lazy(dict):
    """A dict whose values are built on first access from zero-argument factories (plans are only constructed
    for the tables a query actually uses; PySpark analyses every DataFrame as it is built)."""

    def __init__(self, factories=None, **kw):
        super().__init__()
        self._f = dict(factories or {}, **kw)

    def __missing__(self, key):
        if key not in self._f:
            raise KeyError(key)
        v = self._f[key]()
        self[key] = v
        return v

    def __contains__(self, key):
        return key in self._f or dict.__contains__(self, key)

    def keys(self):
        return list(self._f) + [k for k in dict.keys(self) if k not in self._f]

    def __iter__(self):
        return iter(self.keys())

    def items(self):
        return [(k, self[k]) for k in self.keys()]

    def values(self):
        return [self[k] for k in self.keys()]

    def __len__(self):
        return len(self.keys())

    def get(self, key, default=None):
        return self[key] if key in self else default

    def copy(self):
        out = Lazy(self._f)
        for k in dict.keys(self):
            dict.__setitem__(out, k, dict.__getitem__(self, k))
        return out


@dataclass
class Warehouse:
    archives: dict[str, DataFrame] = field(default_factory=dict)
    dims: dict[str, DataFrame] = field(default_factory=dict)
    facts: dict[str, DataFrame] = field(default_factory=dict)
    rejects: dict[str, DataFrame] = field(default_factory=dict)


def sources(spark: SparkSession, sf_dir: str, day: int) -> Lazy:
    return Lazy({
        "Customers": lambda: SI.customers(spark, sf_dir, day),
        "Vehicles": lambda: SI.vehicles(spark, sf_dir, day),
        "Employees": lambda: SI.employees(spark, sf_dir, day),
        "PartsInventory": lambda: SI.parts(spark, sf_dir, day),
        "ServiceAppointments": lambda: SI.appointments(spark, sf_dir, day),
        "ServiceDetails": lambda: SI.details(spark, sf_dir, day),
    })


def initial_archives(spark: SparkSession, sf_dir: str) -> Lazy:
    src = sources(spark, sf_dir, 0)

    def arch(name):
        return lambda: CS.A.archive_initial(CS.prepare_source(name, src[CS.SOURCE_TABLES[name]]),
                                            CS.ENTITIES[name], SI.T0)

    f = {name: arch(name) for name in CS.ENTITIES}
    f["archive_accidents_csv"] = lambda: CS.archive_accidents(SI.accident_extract_raw(spark, sf_dir), SI.T0)
    return Lazy(f)


def initial_dims(arch: dict[str, DataFrame], written: bool | Collection[str] = True) -> Lazy:
    """The dimensions of the full load; those in ``written`` (or all) are materialized when they are first used."""
    def kept(name, build):
        return lambda: materialize(build()) if written is True or (written and name in written) else build()

    return Lazy({k: kept(k, v) for k, v in {
        "dim_date": lambda: CS.dim_date(arch["archive_accidents_csv"], arch["archive_customers"],
                                        arch["archive_service_appointments"], arch["archive_employees"]),
        "dim_location": lambda: CS.dim_location(arch["archive_accidents_csv"], arch["archive_customers"]),
        "dim_weather": lambda: CS.dim_weather(arch["archive_accidents_csv"]),
        "dim_road_features": lambda: CS.dim_road_features(arch["archive_accidents_csv"]),
        "dim_daylight": lambda: CS.dim_daylight(arch["archive_accidents_csv"]),
        "dim_customer": lambda: CS.dim_customer(arch["archive_customers"]),
        "dim_vehicle": lambda: CS.dim_vehicle(arch["archive_vehicles"]),
        "dim_employee": lambda: CS.dim_employee(arch["archive_employees"]),
        "dim_part": lambda: CS.dim_part(arch["archive_parts_inventory"]),
        "dim_service_type": lambda: CS.dim_service_type(arch["archive_service_appointments"]),
    }.items()})


def initial_warehouse(spark: SparkSession, sf_dir: str, share: bool = False,
                      written: bool | Collection[str] = False) -> Warehouse:
    """Full load at T0. ``written``: the dimensions (True: all) that have several readers and are written on first use.
    ``share``: all tables are, for consumers that read them several times (checks over the whole warehouse)."""
    cut = materialize if share else None
    arch = initial_archives(spark, sf_dir)
    if share:
        arch = Lazy({n: (lambda f=f: materialize(f())) for n, f in arch._f.items()})
    dims = initial_dims(arch, True if share else written)
    wh = Warehouse(archives=arch, dims=dims)
    built: dict[str, tuple[DataFrame, DataFrame]] = {}

    def fact(name):
        def make():
            if name not in built:
                if name == "fact_accidents":
                    built[name] = CS.fact_accidents(arch["archive_accidents_csv"], dims, cut=cut)
                elif name == "fact_service_appointments":
                    built[name] = CS.fact_service_appointments(arch["archive_service_appointments"], dims, cut=cut)
                else:
                    built[name] = CS.fact_service_parts_usage(
                        arch["archive_service_details"], arch["archive_service_appointments"], dims, cut=cut)
            return built[name]
        return make

    names = ("fact_accidents", "fact_service_appointments", "fact_service_parts_usage")
    wh.facts = Lazy({n: (lambda m=fact(n): m()[0]) for n in names})
    wh.rejects = Lazy({n: (lambda m=fact(n): m()[1]) for n in names})
    return wh


def write_together(wh: Warehouse, archives: Collection[str] = (), dims: Collection[str] = (),
                   facts: Collection[str] = ()) -> None:
    """Write tables that would be written one after the other on first use, layer by layer, those of a layer together."""
    for layer, names in ((wh.archives, archives), (wh.dims, dims), (wh.facts, facts)):
        together({n: (lambda layer=layer, n=n: layer[n]) for n in names})


def diff_entity(spark: SparkSession, sf_dir: str, archive: DataFrame, entity: str, day: int) -> DataFrame:
    """Snapshot diff of one entity's day-``day`` source against the archive's open versions."""
    src = sources(spark, sf_dir, day)[CS.SOURCE_TABLES[entity]]
    return CS.snapshot_diff(entity, src, archive)


def archive_after(archive: DataFrame, diff: DataFrame, run_ts) -> DataFrame:
    """Whole archive after a run: earlier closed versions + versions closed now + open versions after."""
    history = archive.filter(F.col(A.VALID_TO) != ts_lit(FAR_FUTURE))
    return history.unionByName(A.closed_versions(diff, run_ts)).unionByName(A.open_after(diff, run_ts))


def archives_at(spark: SparkSession, sf_dir: str, entity: str, day: int) -> DataFrame:
    """The archive of ``entity`` after the runs of days 0..``day``."""
    arch = initial_archives(spark, sf_dir)[entity]
    for d, ts in ((1, SI.T1), (2, SI.T2))[:day]:
        if d > 1:
            arch = materialize(arch)  # the next run reads what the previous one wrote
        diff = diff_entity(spark, sf_dir, arch, entity, d)
        arch = archive_after(arch, diff, ts)
    return arch


def incremental_warehouse(spark: SparkSession, sf_dir: str, initial: Warehouse | None = None) -> Warehouse:
    """The warehouse after the day-1 run at T1: archives diffed and materialised, SCD-2 dimensions updated over
    ``(T0, T1]``, calendar and service types extended, new facts of the window built against current rows."""
    wh0 = initial or initial_warehouse(spark, sf_dir, written=True)
    src1 = sources(spark, sf_dir, 1)

    def arch_of(name):
        def make():
            # a run writes its diff, which several outputs are derived from, and its archive, which later layers read
            diff = materialize(A.to_write(CS.snapshot_diff(name, src1[CS.SOURCE_TABLES[name]], wh0.archives[name])))
            return materialize(archive_after(wh0.archives[name], diff, SI.T1))
        return make

    arch1 = Lazy({name: arch_of(name) for name in CS.ENTITIES})
    arch1._f["archive_accidents_csv"] = lambda: wh0.archives["archive_accidents_csv"]

    def scd(dim_name, arch_name):
        return lambda: materialize(CS.scd2_update(wh0.dims[dim_name], arch1[arch_name], dim_name, SI.T0, SI.T1))

    f = {d: scd(d, a) for d, a in CS.SCD2_ARCHIVE.items()}
    f["dim_date"] = lambda: wh0.dims["dim_date"].unionByName(CS.dim_date_incremental(
        arch1["archive_service_appointments"], wh0.dims["dim_date"], SI.T0, SI.T1))
    f["dim_service_type"] = lambda: wh0.dims["dim_service_type"].unionByName(CS.dim_service_type_incremental(
        arch1["archive_service_appointments"], wh0.dims["dim_service_type"], SI.T0, SI.T1))
    for d in ("dim_location", "dim_weather", "dim_road_features", "dim_daylight"):
        f[d] = (lambda d=d: wh0.dims[d])
    dims1 = Lazy(f)
    built: dict[str, tuple[DataFrame, DataFrame]] = {}

    def f4():
        if "a" not in built:
            built["a"] = CS.fact_service_appointments_incremental(
                arch1["archive_service_appointments"], wh0.facts["fact_service_appointments"], dims1, SI.T0, SI.T1)
        return built["a"]

    def f5():
        if "p" not in built:
            built["p"] = CS.fact_service_parts_usage_incremental(
                arch1["archive_service_details"], arch1["archive_service_appointments"],
                wh0.facts["fact_service_parts_usage"], dims1, SI.T0, SI.T1)
        return built["p"]

    return Warehouse(
        archives=arch1, dims=dims1,
        facts=Lazy({"fact_service_appointments": lambda: f4()[0], "fact_service_parts_usage": lambda: f5()[0]}),
        rejects=Lazy({"fact_service_appointments": lambda: f4()[1], "fact_service_parts_usage": lambda: f5()[1]}),
    )
