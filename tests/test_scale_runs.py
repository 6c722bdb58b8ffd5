"""Joined texts: seams looked at in one pass give what each of them gives alone, and runs keep their fields."""

import re

from pyspark.sql import functions as F

from folioforge.functions import text as T
from folioforge.operators import paragraphs

CHARACTERS = ["a", "é", "9", "٣", "(", "'", '"', "/", ".", "-", "%", "]", ")", "한", "😀", "#", "}"]


def test_seams_as_pairs(spark):
    words = [x for a in CHARACTERS for b in CHARACTERS for x in (f"{a}", f"{b} {a}", f"{b}")]
    for extra in ([], [f"x{T.SEAM}y"]):
        df = spark.createDataFrame([(words + extra,)], "w array<string>")
        for rules in (True, False):
            close = df.select(F.transform(F.sequence(F.lit(1), F.size("w") - 1), lambda i: F.concat(F.substring(F.get("w", i - 1), -1, 1), F.substring(F.get("w", i), 1, 1)).rlike(T.close_pattern(rules))).alias("c")).first()["c"]
            every = words + extra
            expected = every[0] + "".join(("" if c else " ") + w for c, w in zip(close, every[1:]))
            assert df.select(T.glued(F.col("w"), rules)).first()[0] == expected


def test_one_pattern_a_text_and_runs_read_in_place(spark):
    df = spark.createDataFrame([(["a"],)], "w array<string>")
    plan = df.select(T.glued(F.col("w"))).select("*")._jdf.queryExecution().analyzed().toString()
    assert "regexp_replace" in plan and T.SEAM in plan
    run = "text string, b boolean, i boolean, u boolean, rStyle string, sz double, color string, image_rids array<string>"
    runs = [(t, b, None, False, "s", z, None, ids) for t, b, z, ids in (("a b", True, 1.0, ["r1"]), ("​", True, 2.0, None), ("c", True, 1.0, ["r2", "r1"]), ("9", True, None, None), (" (d ", True, None, []), (None, False, 1.0, []))]
    got = spark.createDataFrame([(runs,)], f"r array<struct<{re.sub(r'(\w+) ([a-z<>]+)', r'\1:\2', run)}>>").select(paragraphs.coalesce_runs(F.col("r")).alias("r")).first()["r"]
    assert [(x["text"], x["b"], x["sz"], x["image_rids"]) for x in got] == [("a b c", True, 1.0, ["r1", "r2"]), ("9 (d", True, None, [])]
