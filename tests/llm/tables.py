"""Small tables with everything that could trip an operator."""

from __future__ import annotations

import random

from pyspark.sql import DataFrame, SparkSession

WORDS = "the of and to in is it that was for on are with as his they be at one have this from or had by hot word but what".split()
EXTRA = "score predicted lang_pred component_id kept n_shingles line key path at copy piece start length part role deal first".split()


def prose(seed: int, n: int) -> str:
    draw = random.Random(seed)
    return " ".join(draw.choice(WORDS) + draw.choice(["", "", "s", "ed", str(seed)]) for _ in range(n))


def edited(text: str, seed: int, share: float) -> str:
    draw = random.Random(seed)
    return " ".join(draw.choice(WORDS) + "x" if draw.random() < share else w for w in text.split(" "))


def awkward_rows() -> list[tuple[int | None, str | None]]:
    base = prose(1, 120)
    long = "\n".join(prose(k, 60) for k in range(400)) + " " + "unbroken" * 9000
    return [
        (5, base), (3, base), (9, edited(base, 1, 0.04)), (11, edited(base, 2, 0.04)), (12, edited(base, 3, 0.5)),
        (20, None), (21, ""), (22, " \n\t "), (23, "one"), (24, "one"), (25, "***"), (26, "12 34"),
        (30, long), (31, long), (40, "é́ naïve 日本語\u00a0x\u2003y \x1c\r\n z  double  spaces \n\n end "),
        (50, prose(50, 30)), (50, prose(50, 30)), (51, prose(50, 30).upper()), (None, base), (None, prose(7, 40)), (None, None),
        (-4, prose(8, 25) + "\n" + prose(9, 25)), (60, prose(8, 25) + "\n" + edited(prose(9, 25), 5, 0.04)),
    ]


def with_extras(spark: SparkSession, rows: list[tuple], kinds: str = "doc_id long, text string") -> DataFrame:
    """The rows with extra columns whose names operators use themselves."""
    df = spark.createDataFrame(rows, kinds)
    return df.selectExpr("*", *[f"'other' AS {c}" for c in EXTRA if c not in df.columns])


def awkward(spark: SparkSession) -> DataFrame:
    return with_extras(spark, awkward_rows())


def empty(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
