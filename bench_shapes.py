"""The plain shapes of the headline operators, only to measure the library's forms against: match by
joining every text with every pattern, then aggregate and join back once per rule; merge in two passes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from mercato.constants import STORAGE_PATTERNS


def storage(spark: SparkSession, texts: DataFrame) -> DataFrame:
    patterns = spark.createDataFrame(
        [(i, unit, pattern) for i, (unit, pattern) in enumerate(STORAGE_PATTERNS)], "rank int, unit string, pattern string"
    )
    return spark.sql(
        """WITH hits AS (SELECT t.id, p.rank, p.unit, regexp_extract(t.text, p.pattern, 1) AS amount
                         FROM {texts} t JOIN {patterns} p ON regexp_extract(t.text, p.pattern, 1) <> ''),
           best AS (SELECT id, min(rank) AS rank FROM hits GROUP BY id)
           SELECT h.id, CAST(h.amount AS INT) * IF(h.unit = 'TB', 1024, 1) AS storage_gb
           FROM hits h JOIN best b ON b.id = h.id AND b.rank = h.rank""",
        texts=texts,
        patterns=patterns,
    )


_BRANDED = """hits AS (SELECT t.id, t.text, d.brand, regexp_instr(t.text, d.pattern) AS pos
                       FROM {texts} t JOIN {brands} d ON regexp_instr(t.text, d.pattern) > 0),
  first AS (SELECT id, min(pos) AS pos FROM hits GROUP BY id HAVING count(*) <= 3),
  branded AS (SELECT DISTINCT h.id, h.text, h.brand FROM hits h JOIN first f ON f.id = h.id AND f.pos = h.pos)"""


def brand(spark: SparkSession, texts: DataFrame, brands: DataFrame) -> DataFrame:
    return spark.sql(f"WITH {_BRANDED} SELECT id, brand FROM branded", texts=texts, brands=brands)


def model(spark: SparkSession, texts: DataFrame, brands: DataFrame, models: DataFrame) -> DataFrame:
    return spark.sql(
        f"""WITH {_BRANDED},
            found AS (SELECT b.id, b.brand, m.model, m.length, regexp_instr(b.text, m.pattern) AS pos
                      FROM branded b JOIN {{models}} m ON m.brand = b.brand AND regexp_instr(b.text, m.pattern) > 0),
            few AS (SELECT id FROM found GROUP BY id HAVING count(*) < 10),
            longest AS (SELECT id, max(length) AS length FROM found GROUP BY id),
            long AS (SELECT f.* FROM found f JOIN few ON few.id = f.id JOIN longest l ON l.id = f.id AND l.length = f.length),
            early AS (SELECT id, min(pos) AS pos FROM long GROUP BY id)
            SELECT DISTINCT l.id, l.brand, l.model FROM long l JOIN early e ON e.id = l.id AND e.pos = l.pos""",
        texts=texts,
        brands=brands,
        models=models,
    )


def scd2(spark: SparkSession, table: DataFrame, batch: DataFrame) -> DataFrame:
    return spark.sql(
        """WITH closed AS (SELECT t.id, t.priority, t.price, t.hash, t.valid_from,
                                  IF(t.valid_to IS NULL AND b.hash <> t.hash, TIMESTAMP '2002-01-01', t.valid_to) AS valid_to
                           FROM {table} t LEFT JOIN {batch} b ON b.id = t.id)
           SELECT * FROM closed UNION ALL
           SELECT b.id, b.priority, b.price, b.hash, TIMESTAMP '2002-01-01', CAST(NULL AS TIMESTAMP)
           FROM {batch} b LEFT ANTI JOIN closed c ON c.id = b.id AND c.valid_to IS NULL""",
        table=table,
        batch=batch,
    )
