"""The registered queries of the corpus operators and their SQL twins."""

from __future__ import annotations

from opsframe.llm import (
    centroids, decontaminate, exact_dedup, languages, line_dedup, near_dedup, packing, quality, secrets,
    sharding, token_files, toxicity, vector_codes,
)

MODULES = (packing, quality, secrets, sharding, near_dedup, exact_dedup, toxicity, token_files,
           line_dedup, decontaminate, vector_codes, languages, centroids)


def queries() -> dict:
    return {module.QUERY.__name__: module.QUERY for module in MODULES}


def oracle_sql() -> dict[str, str]:
    return {m.QUERY.__name__: m.SQL for m in MODULES if getattr(m, "SQL", None)}
