"""The queries of this package, and the DuckDB SQL of those that SQL can express."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..session import tune
from . import bpe, collocations, filteraudit, langid, mixing, packing, pathjoin, permindex, quality, rollups, simhash, toxicity, urlfilter


def tuned(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    @functools.wraps(fn)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        tune(spark)
        return fn(spark, sf_dir.rstrip("/"))
    return run


QUERIES = {fn.__name__: tuned(fn) for fn in (
    mixing.op1_mix, langid.op2_language, pathjoin.op3_near_duplicates, toxicity.op4_toxicity,
    simhash.op5_simhash, quality.op6_quality, packing.op7_pack, rollups.op8_token_rollup,
    urlfilter.op9_url_filter, permindex.op10_nearest,
    collocations.op11_collocations, bpe.op12_bpe, filteraudit.op13_filter_audit, rollups.token_rollup_words)}
ORACLES = {"op1_mix": mixing.ORACLE, "token_rollup_words": rollups.ORACLE, "op9_url_filter": urlfilter.ORACLE,
           "op11_collocations": collocations.ORACLE, "op13_filter_audit": filteraudit.ORACLE}
