"""The queries on embeddings, and their SQL where SQL can say it."""

from pyspark.sql import functions as F

from barloom.llm.neighbour_graph import build, search, sound_vectors
from barloom.llm.registry import query, table
from barloom.llm.vector_codes import codebooks_digest, compress, with_label_error

_ROUNDS = 6


@query("op11_nearest_neighbours")
def op11_nearest_neighbours(spark, folder):
    rows = sound_vectors(table(spark, folder, "embeddings"))
    return search(build(rows), rows.filter(F.col("id") % 50 == 0), k=5)


def _codes_sql() -> str:
    """The rounds one below the other: assignment ``a1`` to codebook ``c0``, codebook ``c1``, and so on."""
    steps = []
    for k in range(_ROUNDS + 1):
        steps.append(f"""d{k} AS MATERIALIZED (
            SELECT rid, p.part, entry, list_sum(list_transform(list_zip(p.x, c.x), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS dist
            FROM p JOIN c{k} c ON p.part = c.part
        ), a{k} AS MATERIALIZED (
            SELECT rid, part, min(struct_pack(dist := dist, entry := entry)) AS best FROM d{k} GROUP BY ALL
        )""")
        if k < _ROUNDS:
            steps.append(f"""m{k} AS MATERIALIZED (
                SELECT part, entry, list(m ORDER BY place) AS x FROM (
                    SELECT a.part, a.best.entry AS entry, place, (sum(x[place]) - ((sum(x[place]) % count(*)) + count(*)) % count(*)) // count(*) AS m
                    FROM a{k} a JOIN p ON a.rid = p.rid AND a.part = p.part, unnest(range(1, len(x) + 1)) AS r(place)
                    GROUP BY 1, 2, 3
                ) GROUP BY 1, 2
            ), c{k + 1} AS MATERIALIZED (
                SELECT part, entry, coalesce(m.x, c.x)::BIGINT[] AS x FROM c{k} c LEFT JOIN m{k} m USING (part, entry)
            )""")
    last = _ROUNDS
    return f"""
    WITH v AS MATERIALIZED (
        SELECT row_number() OVER (ORDER BY vec_id, embedding) AS rid, vec_id, label,
            list_transform(embedding, lambda x: floor(x::DOUBLE * 4096)::BIGINT) AS x
        FROM embeddings
        WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    ), p AS MATERIALIZED (
        SELECT rid, part, x[part * (len(x) // 8) + 1 : (part + 1) * (len(x) // 8)] AS x FROM v, unnest(range(8)) AS r(part)
    ), c0 AS MATERIALIZED (
        SELECT part, rid - 1 AS entry, x FROM p WHERE rid <= 16
    ), {', '.join(steps)}, coded AS (
        SELECT rid, string_agg(printf('%02x', best.entry), '' ORDER BY part) AS code, sum(best.dist)::BIGINT AS error
        FROM a{last} GROUP BY rid
    ), books AS (
        SELECT sha256(string_agg(array_to_string(x, ','), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM c{last}
    )
    SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256
    FROM v JOIN coded USING (rid), books
    """


@query("op13_vector_codes", _codes_sql())
def op13_vector_codes(spark, folder):
    coded, books = compress(table(spark, folder, "embeddings"), rounds=_ROUNDS)
    two_digits = lambda entry: F.lower(F.lpad(F.hex(entry), 2, "0"))
    return with_label_error(coded).select(
        F.col("id").alias("vec_id"),
        F.array_join(F.transform("codes", two_digits), "").alias("code"),
        "error",
        "label_error",
        F.lit(codebooks_digest(books)).alias("codebooks_sha256"),
    )
