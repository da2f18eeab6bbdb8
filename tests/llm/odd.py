"""Awkward documents that every operator must take: NULLs, empty and long texts, copies, clashing names."""

import random

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, score string, size long, kept string, "
          "component string, copy string, _w string, _letter string, _found string, _key string")


def words(seed: int, n: int) -> str:
    r = random.Random(seed)
    return " ".join("".join(r.choice("abcdefghijklmnoprstu") for _ in range(r.randint(2, 8))) for _ in range(n))


def texts() -> dict:
    long = words(1, 30_000)
    base = words(2, 300)
    passage = words(3, 90)
    return {
        0: base, 1: base, 2: base.replace(base.split()[150], "zzz", 1), 3: words(4, 200) + "\n" + passage + "\n" + words(5, 100),
        4: words(6, 50) + " " + passage + " " + words(7, 10), 5: None, 6: "", 7: " \t\n ", 8: "one", 9: "one two three",
        10: long, 11: "a" * 3000, 12: "12 34 .. !!", 13: "日本語の文章 " * 100, 14: "naïve été " * 80,
        15: "one two three", 16: words(8, 120), 17: "Released under the MIT License. " + words(9, 60),
    }


def documents(spark, rows=None):
    rows = texts() if rows is None else rows
    data = [(k, t, ("en" if k % 3 else "de") if k != 16 else None, f"s{k % 2}" if k % 5 else None, len(t or ""), "x", None, "k", "c", "y", "w", "l", "f", "q")
            for k, t in rows.items()]
    return spark.createDataFrame(data, SCHEMA).drop("size") if rows else spark.createDataFrame([], SCHEMA).drop("size")


def with_repeats(spark):
    """A row twice, and two rows without an id."""
    docs = documents(spark)
    import pyspark.sql.functions as F
    return docs.unionByName(docs.where("doc_id = 3")).unionByName(docs.where("doc_id IN (4, 16)").withColumn("doc_id", F.lit(None).cast("long")))
