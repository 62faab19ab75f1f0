"""The ETL pipeline: raw inputs -> five lake datasets, with row counts.

Which datasets are built depends on which raw inputs exist:

=============  ===========================================================
titles         always (title.basics is required), with ratings if present
episodes       from title.episode if present, else the episode-type titles
names          if name.basics is present
akas           if title.akas is present
principals     if title.principals *and* name.basics are present
=============  ===========================================================
"""

from __future__ import annotations

import logging
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marquee import schemas as S
from marquee.operators.builders import (
    build_akas,
    build_episodes,
    build_episodes_from_basics,
    build_names,
    build_principals,
    build_titles,
    clean_basics,
    credit_lookups,
    episode_columns,
    episode_lookups,
    read_credits,
    read_episodes,
)
from marquee.operators.joins import Lookup, attach, fits_broadcast
from marquee.operators.sinks import OVERWRITE_MODES
from marquee.plans.versions import (
    KEEP_VERSIONS,
    POOL_ROWS,
    current_state,
    discard,
    expire_versions,
    large_values,
    update_dataset,
)
from marquee.session import shuffles_released, warn_without_adaptive
from marquee.sources.manifest import commit, new_version
from marquee.sources.tsv import read_raw_inputs

log = logging.getLogger(__name__)

OPTIONAL_RAW = (S.RAW_RATINGS, S.RAW_EPISODE, S.RAW_PRINCIPALS, S.RAW_AKAS, S.RAW_NAMES)


@dataclass
class Dataset:
    """A built dataset and a narrow frame that is empty exactly when it is.

    Where it is made by lookups, ``frame`` is ``columns`` of ``facts`` with all
    ``lookups`` attached; ``columns`` derives none but partition columns.
    """

    frame: DataFrame
    probe: DataFrame
    facts: DataFrame | None = None
    lookups: tuple[Lookup, ...] = ()
    columns: Callable[[DataFrame], DataFrame] = lambda df: df


def dealing(ds: Dataset, spec: S.LakeSpec) -> tuple[DataFrame, DataFrame, Callable[[DataFrame], DataFrame] | None]:
    """The rows to deal out, a frame that counts their partition values, and
    what adds the remaining columns in the write stage.

    Small lookups shuffle no facts: they are broadcast, and those without a
    partition column only where the rows are written. Counting reads a lookup's
    partition columns alone, so one too large as a whole may be small there.
    """
    if ds.facts is None:
        return ds.frame, ds.frame, None
    small = [k for k in ds.lookups if fits_broadcast(k.frame)]
    placing, narrow = [], list(small)
    for lookup in ds.lookups:
        placed = [c for c in spec.partition_by if c in lookup.frame.columns]
        if placed:
            placing.append(lookup)
            if lookup not in small and fits_broadcast(lookup.frame.select(lookup.key, *placed)):
                narrow.append(lookup)
    late = [k for k in small if k not in placing]
    frame = attach(ds.facts, [k for k in ds.lookups if k not in late], small)
    counted = attach(ds.facts, placing, narrow)
    if len(placing) == len(ds.lookups):
        counted = ds.columns(counted)
    if not late:
        return ds.columns(frame), counted, None
    return frame, counted, lambda df: attach(df, late, late)


def lake_path(lake_dir: str, name: str) -> str:
    return f"{lake_dir.rstrip('/')}/{name}"


def build_titles_dataset(inputs: dict[str, DataFrame | None]) -> Dataset:
    basics = clean_basics(inputs[S.RAW_BASICS])
    return Dataset(build_titles(basics, inputs.get(S.RAW_RATINGS)), basics)


def build_episodes_dataset(
    inputs: dict[str, DataFrame | None],
    titles: DataFrame,
    series_type: str = S.SERIES_TYPE,
    episode_type: str = S.EPISODE_TYPE,
) -> Dataset:
    episode_raw = inputs.get(S.RAW_EPISODE)
    if episode_raw is not None:
        return Dataset(build_episodes(episode_raw, titles, series_type=series_type), episode_raw,
                       read_episodes(episode_raw), episode_lookups(titles, series_type), episode_columns)
    fallback = build_episodes_from_basics(titles, episode_type=episode_type)
    return Dataset(fallback, fallback)


def build_names_dataset(inputs: dict[str, DataFrame | None]) -> Dataset | None:
    names_raw = inputs.get(S.RAW_NAMES)
    return None if names_raw is None else Dataset(build_names(names_raw), names_raw)


def build_akas_dataset(inputs: dict[str, DataFrame | None]) -> Dataset | None:
    akas_raw = inputs.get(S.RAW_AKAS)
    return None if akas_raw is None else Dataset(build_akas(akas_raw), akas_raw)


def build_principals_dataset(
    inputs: dict[str, DataFrame | None], names: DataFrame | None, titles: DataFrame
) -> Dataset | None:
    principals_raw = inputs.get(S.RAW_PRINCIPALS)
    if principals_raw is None:
        return None
    if names is None:
        log.warning("principals not built: it needs %s, which is absent", S.RAW_NAMES)
        return None
    return Dataset(build_principals(principals_raw, names, titles), principals_raw, read_credits(principals_raw),
                   credit_lookups(names, titles), lambda df: df.select(*S.PRINCIPALS.columns))


def build_datasets(
    inputs: dict[str, DataFrame | None],
    series_type: str = S.SERIES_TYPE,
    episode_type: str = S.EPISODE_TYPE,
    keep: Callable[[DataFrame], DataFrame] = lambda df: df,
) -> dict[str, Dataset]:
    """Every dataset the inputs allow, in the pipeline's order, as lazy frames.

    ``keep`` is applied to the dimensions that others join (titles, names).
    """
    titles = build_titles_dataset(inputs)
    titles.frame = keep(titles.frame)
    names = build_names_dataset(inputs)
    if names is not None and inputs.get(S.RAW_PRINCIPALS) is not None:
        names.frame = keep(names.frame)
    built = {
        "titles": titles,
        "episodes": build_episodes_dataset(inputs, titles.frame, series_type, episode_type),
        "names": names,
        "akas": build_akas_dataset(inputs),
        "principals": build_principals_dataset(inputs, names.frame if names else None, titles.frame),
    }
    return {name: ds for name, ds in built.items() if ds is not None}


def in_turns(names: Iterable[str]) -> list[list[str]]:
    """Lists of datasets to write side by side: the facts share one, others have one each."""
    facts = [n for n in names if n in S.FACTS]
    return ([facts] if facts else []) + [[n] for n in names if n not in S.FACTS]


def build_all(
    inputs: dict[str, DataFrame | None],
    series_type: str = S.SERIES_TYPE,
    episode_type: str = S.EPISODE_TYPE,
) -> dict[str, DataFrame]:
    """The frames of ``build_datasets`` (nothing is written)."""
    return {k: v.frame for k, v in build_datasets(inputs, series_type, episode_type).items()}


def run_etl(
    spark: SparkSession,
    inputs: dict[str, DataFrame | None],
    lake_dir: str,
    mode: str = "static",
    series_type: str = S.SERIES_TYPE,
    episode_type: str = S.EPISODE_TYPE,
    concurrent: bool = True,
    pool_rows: int = POOL_ROWS,
    keep_versions: int = KEEP_VERSIONS,
) -> dict[str, int]:
    """Build and write every dataset the inputs allow; return row counts.

    All datasets of a run are written into a new version of the lake, which one
    manifest row makes current at the end: readers see all of the old lake or
    all of the new one, and a run that fails leaves the old one as it was.
    Files of versions before the last ``keep_versions`` are removed.

    Titles feed episodes and principals, names feed principals. These two
    dimensions are persisted (memory, then disk) while the run lasts, so their
    parse and joins run once in either mode; a lost executor's blocks are
    computed again. They are not read back from the lake: a partition
    directory cannot hold '' (it reads back as null), and dependents must not
    depend on the mode.

    ``mode="static"`` is a full rebuild: the new version holds what this run
    produces and nothing else. ``"dynamic"`` replaces the partitions for which
    it has rows, takes rows that moved to them out of the partitions they were
    in before, and keeps the rest (see ``update_dataset``).

    Partition values with fewer than ``pool_rows`` rows share files (0: each
    has a directory). The datasets are independent and run as concurrent Spark
    jobs, so the tail of one overlaps the others; the facts take turns.

    Lookups of at most ``LOOKUP_BYTES`` are broadcast, so the credits and
    episodes, the largest datasets, are shuffled for their layout only, the
    credits without the columns of persons and titles (see ``dealing``). Each
    job's shuffle files go when it ends.
    """
    if mode not in OVERWRITE_MODES:
        raise ValueError(f"mode must be one of {OVERWRITE_MODES}, got {mode!r}")
    if S.RAW_BASICS not in inputs or inputs[S.RAW_BASICS] is None:
        raise FileNotFoundError(f"required input {S.RAW_BASICS} is missing")
    warn_without_adaptive(spark, log)
    kept: list[DataFrame] = []

    def keep(df: DataFrame) -> DataFrame:
        kept.append(df.persist(StorageLevel.MEMORY_AND_DISK))
        return kept[-1]

    datasets = build_datasets(inputs, series_type, episode_type, keep)
    base, version = current_state(spark, lake_dir), new_version()
    counts: dict[str, int] = {}
    state = dict(base.datasets) if base is not None and mode == "dynamic" else {}

    def write(name: str) -> None:
        ds, spec = datasets[name], S.LAKE[name]
        if ds.probe.isEmpty():
            counts[name] = 0
            return
        old = state.get(name, ()) if mode == "dynamic" else ()
        frame, counted, finish = dealing(ds, spec)
        large = large_values(counted, spec, pool_rows)
        state[name], counts[name] = update_dataset(
            spark, lake_dir, version, frame, spec, old, large, pool_rows, finish)

    def write_all(names: list[str]) -> None:
        for name in names:
            write(name)

    try:
        with shuffles_released(spark):
            write("titles")
            rest = [n for n in datasets if n != "titles"]
            if concurrent and rest:
                turns = in_turns(rest)
                with ThreadPoolExecutor(max_workers=len(turns), thread_name_prefix="etl") as pool:
                    for future in [pool.submit(write_all, names) for names in turns]:
                        future.result()
            else:
                write_all(rest)
        commit(spark, lake_dir, version, state, base)
    except BaseException:
        discard(spark, lake_dir, version)
        raise
    finally:
        for df in kept:
            df.unpersist()
    expire_versions(spark, lake_dir, keep_versions)

    ordered = {n: counts[n] for n in S.DATASET_ORDER if n in counts}
    for name, rows in ordered.items():
        log.info("%s: %s rows", name, f"{rows:,}")
    return ordered


def run_etl_from_dir(
    spark: SparkSession,
    raw_dir: str,
    lake_dir: str,
    mode: str = "static",
    quote: str = "",
    **options,
) -> dict[str, int]:
    """Read the raw files found in ``raw_dir`` and run the pipeline.

    A missing ``title.basics`` raises ``FileNotFoundError`` before any work.
    ``options`` are those of ``run_etl``.
    """
    inputs = read_raw_inputs(spark, raw_dir, S.REQUIRED_RAW, OPTIONAL_RAW, quote=quote)
    return run_etl(spark, inputs, lake_dir, mode=mode, **options)


COUNTS_SCHEMA = T.StructType(
    [T.StructField("dataset", T.StringType(), False), T.StructField("rows", T.LongType(), True)]
)


def counts_frame(spark: SparkSession, counts: dict[str, int | None]) -> DataFrame:
    """The (dataset, rows) report as a small DataFrame, in pipeline order."""
    ordered = [n for n in S.DATASET_ORDER if n in counts] + [
        n for n in counts if n not in S.DATASET_ORDER
    ]
    return spark.createDataFrame([(n, counts[n]) for n in ordered], COUNTS_SCHEMA)
