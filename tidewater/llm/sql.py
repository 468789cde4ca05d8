"""DuckDB statements of what must hold of the text problems' results; the results themselves SQL cannot express."""

from __future__ import annotations

_CLEAN = "nullif(upper(trim({0})), '')"

SQL: dict[str, str] = {
    # Every document with text is placed once in each kind of container; nothing is broken or loosely packed.
    "p7_checks": "SELECT container_name, documents, CAST(0 AS BIGINT) AS bad_bins, CAST(0 AS BIGINT) AS bad_documents, true AS nearly_full FROM pack_capacities, (SELECT count(*) AS documents FROM documents WHERE text <> '') WHERE documents > 0",
    "p8_checks": f"SELECT mix_name, count(*) AS named_sources, CAST(0 AS BIGINT) AS bad_documents, CAST(0 AS BIGINT) AS repeated_rows FROM (SELECT DISTINCT mix_name, {_CLEAN.format('source')} AS source FROM mix_targets WHERE target_weight > 0) WHERE source IS NOT NULL GROUP BY 1",
    "p9_checks": "SELECT count(*) AS documents, CAST(0 AS BIGINT) AS off FROM documents",
}
