"""Small tables with odd rows, and plain versions of the word rules."""

from __future__ import annotations

import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, n_words string, id string, node string"


def words(text):
    return WORD.findall(text or "")


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


BASE = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen".split()
LONG = " ".join(f"w{i}é{i * 7 % 13}" for i in range(3000))
ODD = [
    (1, None),
    (2, ""),
    (3, " \t\n "),
    (4, "one"),
    (5, "One  TWO\nthree"),
    (6, "one two three"),
    (7, " ".join(BASE)),
    (8, " ".join(BASE).upper()),
    (9, " ".join([*BASE, "tail"])),
    (10, "same line here\n" * 40),
    (11, LONG),
    (12, LONG + " more"),
    (12, LONG + " more"),
    (13, "x" * 5000 + " " + "9" * 3000 + "@" * 50),
    (14, "Ünï cödé nbsp   \U0001f600 \x1c \x85 end <|endoftext|> it's"),
    (None, " ".join(BASE)),
    (None, None),
    (15, " ".join(f"u{i}" for i in range(400))),
    (16, " ".join(f"u{i}" for i in range(8, 400))),
    (17, " ".join(f"u{i}" for i in range(50, 400))),
]


def odd_documents(spark, rows=ODD):
    full = [(i, t, "en", "s", None if t is None else len(t), "clash", "clash", None) for i, t in rows]
    return spark.createDataFrame(full, SCHEMA)


def documents(spark, sf_dir="/root/testdata/sf0.001"):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def rows_of(df):
    return [r.asDict() for r in df.collect()]
