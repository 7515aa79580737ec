"""ChainAnalytics: the five entry points as lazy DataFrame plans.

    ca = ChainAnalytics(spark, raw_visits, "2024-01-02", "2024-01-29", goals=[-1])
    ca.prepare_visits()            # one live row per visit
    ca.combine_visits()            # touches (long form); D computed once
    ca.simple_attributions()       # five positional models per source
    ca.associated_conversions()
    ca.source_in_chains_metrics()
    ca.chains()                    # chain table: one row per element with (chain, pos)

Without a path the live visits are still stored once, as parquet under the session's
checkpoint directory, since every later step reads them (``release`` deletes them). ``materialize=True`` on
``combine_visits`` writes the touch table as parquet under that
directory (``spark.checkpoint.dir``, shared storage on a cluster), so the
reports and the chain table start from stored rows instead of replaying the
collapse and windows, and a lost executor costs only its own tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

from touchline.operators import attribution, positions, reports
from touchline.operators.chains import chains as chain_table
from touchline.operators.gap_state import gap_quantile_of_state
from touchline.operators.gaps import gap_quantile
from touchline.operators.skew import AUTO, BLOCK_ROWS, HOT_USER_ROWS, hot_user_lists
from touchline.operators.touches import touches
from touchline.operators.visits import latest_live_visits
from touchline.session import checkpointed, delete_paths, recorded
from touchline.sources.names import UNKNOWN_SOURCE_NAME, no_source_names
from touchline.sources.sinks import publish_chains, publish_visits, write_chains, write_visits


class ChainAnalytics:
    def __init__(self, spark: SparkSession, raw_visits: DataFrame, start_date: str, end_date: str,
                 goals: Sequence[int] = (-1,), percentile: float = 0.95,
                 max_gap: float | None = None, sample_denominator: int | None = None,
                 sample_method: str = "hash", source_names: DataFrame | None = None,
                 unknown_name: str = UNKNOWN_SOURCE_NAME, exact_ad_prefix: bool = False,
                 hot_user_rows: int | None = HOT_USER_ROWS, block_rows: int = BLOCK_ROWS,
                 literal_banner_column: bool = False,
                 gap_state: tuple[DataFrame, DataFrame] | None = None):
        """``gap_state``: the stored daily state (``operators.gap_state``) that D is merged from, instead of a window
        pass over the visits; it must cover the period."""
        if max_gap is not None and max_gap < 0:
            raise ValueError("max_gap must not be negative")
        self.spark = spark
        self.raw_visits = raw_visits
        self.start_date = start_date
        self.end_date = end_date
        self.goals = list(goals)
        self.percentile = percentile
        self._max_gap = max_gap
        self.sample_denominator = sample_denominator
        self.sample_method = sample_method
        self.source_names = source_names
        self.unknown_name = unknown_name
        self.exact_ad_prefix = exact_ad_prefix
        self.hot_user_rows = hot_user_rows
        self.literal_banner_column = literal_banner_column
        self.block_rows = block_rows
        self.gap_state = gap_state
        self._visits = None
        self._touches = None
        self._measures = None
        self._persisted: list[DataFrame] = []
        self._stored: list[str] = []
        self._hot = AUTO

    # -- step 1 --------------------------------------------------------
    def prepare_visits(self, path: str | None = None, persist: bool = True, published: bool = False) -> DataFrame:
        """The live visits. With ``path`` they are written (partitioned by StartDate) and read back, with
        ``published`` as a new version that readers of the path switch to in one step; otherwise they are stored under ``spark.checkpoint.dir``, since the hot-user count, the quantile
        and the chain pass all read them (``persist=False``: left as a plan)."""
        v = latest_live_visits(self.raw_visits, self.start_date, self.end_date, self.goals)
        if path and published:
            v = self.spark.read.parquet(publish_visits(v, path))
        elif path:
            write_visits(v, path)
            v = self.spark.read.parquet(path)
        elif persist:
            with recorded(self._stored):
                v = checkpointed(v, "visits")
        self._visits = v
        return v

    @property
    def visits(self) -> DataFrame:
        return self._visits if self._visits is not None else self.prepare_visits()

    # -- step 2 --------------------------------------------------------
    def visit_gap_threshold(self) -> float | None:
        """D: the given max_gap, or the percentile of gaps (one small action)."""
        if self._max_gap is None and self.gap_state is not None:
            self._max_gap = gap_quantile_of_state(*self.gap_state, self.start_date, self.end_date, self.percentile)
        elif self._max_gap is None:
            visits, hot = self.visits, self._hot_lists()[0]
            with recorded(self._stored):
                self._max_gap = gap_quantile(visits, self.percentile, self.sample_denominator, self.sample_method,
                                             self.hot_user_rows, self.block_rows, hot=hot)
        return self._max_gap

    def combine_visits(self, materialize: bool = False, persist: bool = True, credits: bool = True) -> DataFrame:
        """The touch table. It feeds the chain table and all reports, so it is
        kept: written under ``spark.checkpoint.dir`` and read back with
        ``materialize=True`` (lineage cut, survives executor loss), else
        persisted (memory, spilling to disk; lost blocks are recomputed).
        ``credits=False``: only the columns that chains read (see ``operators.touches``), for a caller
        that makes no report; it is not kept for later calls."""
        threshold, hot = self.visit_gap_threshold(), self.hot_users()
        with recorded(self._stored):
            t = touches(self.visits, threshold, self.exact_ad_prefix, hot_user_rows=self.hot_user_rows,
                        block_rows=self.block_rows, hot=hot, literal_banner_column=self.literal_banner_column,
                        credits=credits)
            if materialize:
                t = checkpointed(t, "touches")
        if persist and not materialize:
            t = t.persist(StorageLevel.MEMORY_AND_DISK)
            self._persisted.append(t)
        if credits:
            self._touches = t
            self._measures = None
        return t

    @property
    def touches(self) -> DataFrame:
        return self._touches if self._touches is not None else self.combine_visits()

    def _hot_lists(self):
        """(hot UserIDs, hot (CounterID, UserID) pairs), found once with one aggregation."""
        if self._hot is AUTO:
            with recorded(self._stored):
                self._hot = hot_user_lists(self.visits.select("CounterID", "UserID"), self.hot_user_rows)
        return self._hot

    def hot_users(self) -> DataFrame | None:
        """(CounterID, UserID) with more than hot_user_rows visits (bounded list), or None."""
        return self._hot_lists()[1]

    def chains(self, path: str | None = None, published: bool = False) -> DataFrame:
        """The chain table (one row per element with its chain and position; see operators.chains), written and
        read back like the visits if there is a path."""
        t, threshold, hot = self.touches, self.visit_gap_threshold(), self.hot_users()
        with recorded(self._stored):
            c = chain_table(t, threshold, self.end_date, self.hot_user_rows, self.block_rows, hot=hot)
        if path and published:
            c = self.spark.read.parquet(publish_chains(c, path))
        elif path:
            write_chains(c, path)
            c = self.spark.read.parquet(path)
        return c

    # -- step 3: reports ------------------------------------------------
    def measures(self) -> DataFrame:
        """Per-source raw measures of every report, computed in one pass and kept (tiny)."""
        if self._measures is None:
            self._measures = positions.source_measures(self.touches).persist()
            self._persisted.append(self._measures)
        return self._measures

    def release(self) -> None:
        """Drop the persisted intermediates and delete those stored under ``spark.checkpoint.dir``
        (visits or chains written to a path of the caller's stay)."""
        for df in self._persisted:
            df.unpersist()
        self._persisted.clear()
        delete_paths(self.spark, self._stored)

    def _names(self) -> DataFrame:
        return self.source_names if self.source_names is not None else no_source_names(self.spark)

    @staticmethod
    def _shown(df: DataFrame, debug: bool) -> DataFrame:
        if debug:   # the plan Spark will run, in place of printing query text
            df.explain("formatted")
        return df

    def simple_attributions(self, debug: bool = False) -> DataFrame:
        return self._shown(reports.with_names(reports.simple_attributions(self.measures()), self._names(),
                                              self.unknown_name), debug)

    def associated_conversions(self, debug: bool = False) -> DataFrame:
        return self._shown(reports.with_names(reports.associated_conversions(self.measures()), self._names(),
                                              self.unknown_name), debug)

    def source_in_chains_metrics(self, debug: bool = False) -> DataFrame:
        return self._shown(reports.with_names(positions.position_metrics(self.measures()), self._names(),
                                              self.unknown_name), debug)

    def top_report(self, view: str, k: int = 10, labels: dict[str, str] | None = None) -> DataFrame:
        """The display tables: ``simple`` (by LastClickRevenue), ``associated`` (by
        AssociatedConvs, counts with thousands separators), ``chains`` / ``conv_chains``
        (position shares as percentages, by unique_chains_perc / unique_conv_chains_perc)."""
        if view == "simple":
            return reports.top_sources_report(self.simple_attributions(), "LastClickRevenue", k, labels=labels)
        if view == "associated":
            return reports.top_associated(self.associated_conversions(), k, labels)
        if view in ("chains", "conv_chains"):
            return reports.top_chains(self.source_in_chains_metrics(), view == "conv_chains", k, labels)
        raise ValueError(f"unknown view {view!r}")

    # -- the stand-alone parts, as the source system queries them -------
    def attribution_part(self, model: str) -> DataFrame:
        fn = {
            "last_click": attribution.attr_last_click,
            "first_click": attribution.attr_first_click,
            "last_significant": attribution.attr_last_significant,
            "last_direct": attribution.attr_last_direct,
        }
        if model in fn:
            return fn[model](self.touches)
        if model == "linear":
            return attribution.attr_linear(self.touches)
        if model == "associated":
            return attribution.associated(self.touches)
        raise ValueError(f"unknown model {model!r}")

    def position_part(self, part: str) -> DataFrame:
        return positions.position_part(self.measures(), part)
