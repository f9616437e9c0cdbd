"""Queries of the subpackage and their SQL."""

from __future__ import annotations

from functools import wraps

from lectern.llm import align, decontaminate, embed, exact, jaccard, language, lines, lm, mixing, packing, runs, toxicity, warc
from lectern.llm.common import bounded_batches


def ready(fn):
    @wraps(fn)
    def run(spark, sf_dir):
        return fn(bounded_batches(spark), sf_dir)

    return run


MODULES = (language, lines, lm, exact, jaccard, warc, packing, mixing, embed, toxicity, align, runs, decontaminate)
QUERIES = {k: ready(v) for m in MODULES for k, v in m.QUERIES.items()}
ORACLES = {k: v for m in MODULES for k, v in m.SQL.items()}
