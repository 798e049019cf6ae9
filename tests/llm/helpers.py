"""Small frames with the cases every operator must cope with."""

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
LONG = "word and more " * 20000
ODD_TEXTS = [
    None, "", " ", "\n", "one", "two words", "a b c d e", LONG, "éàü ñ ß 漢字 🙂 \u00a0x\u2003y\u3000z",
    "\x00\x1c\x1f odd\x85 controls", "x" * 5000, "same text here twice over", "same text here twice over",
    "Same  text\there twice\r\nover", "<|endoftext|> it's I'LL 12345 ½ ²", "e\u0301 combining \u0301 mark",
]


def documents(spark, texts, **extra):
    """Documents with ids from 0 on; extra columns are strings of the value given."""
    rows = [(i, t, "en", f"s{i % 3}", len(t or "")) for i, t in enumerate(texts)]
    frame = spark.createDataFrame(rows, DOCS)
    for name, value in extra.items():
        from pyspark.sql import functions as F

        frame = frame.withColumn(name, F.lit(value))
    return frame


def odd_documents(spark, **extra):
    """Odd texts, a null id, nulls in every column and a repeated row."""
    frame = documents(spark, ODD_TEXTS)
    more = spark.createDataFrame(
        [(None, "null id text of some words", None, None, None), (3, "\n", "en", "s0", 1), (3, "\n", "en", "s0", 1)], DOCS
    )
    frame = frame.unionByName(more)
    for name, value in extra.items():
        from pyspark.sql import functions as F

        frame = frame.withColumn(name, F.lit(value))
    return frame


def no_documents(spark):
    return spark.createDataFrame([], DOCS)


def table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def characters():
    """Code points: all outside the large uniform blocks, and of those (ideographs, private use, unassigned
    planes) every 61st."""
    dense = [*range(0x3400), *range(0xA000, 0xAC00), *range(0xD7A0, 0xD800), *range(0xF900, 0x20000), *range(0xE0000, 0xE0200)]
    sparse = [c for c in range(0, 0x110000, 61) if not 0xD800 <= c < 0xE000]
    return sorted({*dense, *sparse})


def read_without_shuffle(df, column):
    """Whether some scan of the column has no shuffle above it in the plan of df."""
    spark, above, free = df.sparkSession, [], False
    settings = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        lines = df.select("*")._jdf.queryExecution().executedPlan().toString().splitlines()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    for line in lines:
        node = line.lstrip(" :+-")
        depth = len(line) - len(node)
        above = [(d, n) for d, n in above if d < depth]
        if "FileScan" in node and f"{column}#" in node.split("]")[0]:
            free = free or not any(n.startswith("Exchange") for _, n in above)
        above.append((depth, node))
    return free
