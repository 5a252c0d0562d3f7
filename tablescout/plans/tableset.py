"""``TableSet``: an ordered, named list of DataFrames with the profiler API.

Tables are addressed by position (as in the profiled toolkit) or by name.
Methods return DataFrames except where noted; join discovery, histograms and
k-means run jobs when called. The caller's session is used throughout.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from tablescout.functions.hashing import DEFAULT_HASHNUM, DEFAULT_SEED
from tablescout.operators import joinpaths, outliers as outlier_ops, profile
from tablescout.plans import registry
from tablescout.sources.readers import cast_categorical, read_table


class TableSet:
    def __init__(self, tables: Sequence[DataFrame] | Mapping[str, DataFrame], names: Sequence[str] | None = None):
        if isinstance(tables, Mapping):
            names = list(tables.keys())
            tables = list(tables.values())
        self.tables: list[DataFrame] = list(tables)
        self.names: list[str] = list(names) if names is not None else [f"t{i}" for i in range(len(self.tables))]
        if len(self.names) != len(self.tables):
            raise ValueError("one name per table is required")
        self._signatures: dict[tuple, DataFrame] = {}
        self._pair_counts: dict[bool, tuple] = {}

    @classmethod
    def from_paths(
        cls,
        spark: SparkSession,
        paths: Sequence[str],
        categorical_dictionary: Mapping[int | str, Sequence[str]] | None = None,
        names: Sequence[str] | None = None,
        **read_options,
    ) -> TableSet:
        names = list(names) if names is not None else [p.rstrip("/").split("/")[-1].split(".")[0] for p in paths]
        cats = categorical_dictionary or {}
        tables = [read_table(spark, p, cats.get(i, cats.get(names[i], ())), **read_options) for i, p in enumerate(paths)]
        return cls(tables, names)

    def index(self, key: int | str) -> int:
        if isinstance(key, int):
            if not -len(self.tables) <= key < len(self.tables):
                raise IndexError(f"table index {key} out of range")
            return key % len(self.tables)
        return self.names.index(key)

    def __getitem__(self, key: int | str) -> DataFrame:
        return self.tables[self.index(key)]

    def __len__(self) -> int:
        return len(self.tables)

    def cast_categorical(self, categorical_dictionary: Mapping[int | str, Sequence[str]]) -> TableSet:
        """A new set with the listed columns cast to string (signatures are recomputed)."""
        tables = list(self.tables)
        for key, cols in categorical_dictionary.items():
            i = self.index(key)
            tables[i] = cast_categorical(tables[i], cols)
        return TableSet(tables, self.names)

    def _indexes(self, keys):
        return None if keys is None else [self.index(k) for k in keys]

    # -- profiling -------------------------------------------------------
    def describe(self, indexes: Sequence[int | str] | None = None) -> list[DataFrame]:
        chosen = range(len(self.tables)) if indexes is None else [self.index(i) for i in indexes]
        return [profile.describe_table(self.tables[i]) for i in chosen]

    def single_column_evaluation(self, func_str: str, table_indexes, col_names=None, arg_str=None, **kwargs) -> list:
        return registry.single_column_evaluate(
            self.tables, func_str, self._indexes(table_indexes), col_names, arg_str, **kwargs
        )

    # -- join discovery --------------------------------------------------
    def signature(self, hashnum=DEFAULT_HASHNUM, seed=DEFAULT_SEED) -> DataFrame:
        """All string columns' signatures (with distinct counts), computed once per hash family.

        The first call runs one job and checkpoints the result (columns x
        hashnum rows) into the shared checkpoint folder; later join-discovery
        calls with the same ``hashnum`` and ``seed`` reuse it without rescanning.
        """
        key = (hashnum, seed)
        if key not in self._signatures:
            self._signatures[key] = joinpaths.table_set_signature(self.tables, hashnum, seed)
        return self._signatures[key]

    def joining_path_hash(self, threshold=0, table_ind=None, hashnum=DEFAULT_HASHNUM, containing_check=False, seed=DEFAULT_SEED):
        return joinpaths.joining_path_hash(
            self.tables, threshold, self._indexes(table_ind), hashnum, containing_check, seed,
            signature=self.signature(hashnum, seed),
        )

    def joining_path_hash_specific(self, table_index, col_name, threshold=0, hashnum=DEFAULT_HASHNUM, containing_check=False, seed=DEFAULT_SEED):
        return joinpaths.joining_path_hash_specific(
            self.tables, self.index(table_index), col_name, threshold, hashnum, containing_check, seed,
            signature=self.signature(hashnum, seed),
        )

    def multi_set_resemble(self, threshold=0.5, table_ind=None, hashnum=DEFAULT_HASHNUM, containing_check=False, seed=DEFAULT_SEED):
        return joinpaths.multi_set_resemble(
            self.tables, threshold, self._indexes(table_ind), hashnum, containing_check, seed,
            signature=self.signature(hashnum, seed),
        )

    def multi_set_resemble_specific(self, table_ind, col_name, threshold=0, hashnum=DEFAULT_HASHNUM, containing_check=False, seed=DEFAULT_SEED):
        return joinpaths.multi_set_resemble_specific(
            self.tables, self.index(table_ind), col_name, threshold, hashnum, containing_check, seed,
            signature=self.signature(hashnum, seed),
        )

    def exact_pair_counts(self, null_as_value: bool = False):
        """Checkpointed exact shared-value counts of all string-column pairs, computed once."""
        if null_as_value not in self._pair_counts:
            from tablescout.operators.signature import string_long_form

            long = string_long_form(self.tables)
            if long is None:
                raise ValueError("no table has a categorical column, that is one of strings")
            self._pair_counts[null_as_value] = (long, joinpaths.exact_pair_counts(long, null_as_value))
        return self._pair_counts[null_as_value]

    def joining_path_naive(self, threshold=0, table_ind=None, null_as_value=False, round_digits=None):
        return joinpaths.joining_path_naive(
            self.tables, threshold, self._indexes(table_ind), null_as_value, round_digits,
            pair_counts_of=self.exact_pair_counts(null_as_value),
        )

    def jaccard_similarity(self, t1, t2, cname1, cname2, hashnum=DEFAULT_HASHNUM, option="min_hash", seed=DEFAULT_SEED):
        """Scalar (one tiny job)."""
        return joinpaths.get_jaccard_similarity(self.tables, self.index(t1), self.index(t2), cname1, cname2, hashnum, option, seed)

    def hash_collision_check(self, hashnum=DEFAULT_HASHNUM, table_ind=None, seed=DEFAULT_SEED):
        return joinpaths.hash_collision_check(self.tables, hashnum, self._indexes(table_ind), seed)

    # -- outliers --------------------------------------------------------
    def outliers(self, table_index, col_names, num_clusters, cutoff_distance, maxIterations=10,
                 initializationMode="random", wssse=False, seed=None):
        return outlier_ops.outliers(
            self[table_index], col_names, num_clusters, cutoff_distance, maxIterations, initializationMode, wssse, seed
        )


class TableProfiler(TableSet):
    """Path-list entry point: ``TableProfiler(spark, paths, {index: [columns to treat as categorical]})``."""

    def __init__(self, spark: SparkSession, input_path_list: Sequence[str], categorical_dictionary=None, **read_options):
        ts = TableSet.from_paths(spark, input_path_list, categorical_dictionary, **read_options)
        super().__init__(ts.tables, ts.names)
