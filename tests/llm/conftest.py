from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

from aduana.llm.common import importable  # noqa: E402

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"
EXTRA = "slot int, shard_id int, kept string, fp string, row_hash string, text_ string, copies int, `a.b` int"


def prose(n: int, seed: int = 0) -> str:
    """Distinct words in sentences of ten, sentences in lines of three."""
    made = [f"w{(k * 7919 + seed * 104729) % 999983}" for k in range(n)]
    lines = [" ".join(made[k:k + 10]) + "." for k in range(0, n, 10)]
    return "\n".join(" ".join(lines[k:k + 3]) for k in range(0, len(lines), 3))


def edge_rows() -> list[tuple]:
    """Nulls, empty and very long texts, ties, repeated rows and ids, a near copy and short ones."""
    base = prose(300, 1)
    rows = [
        (1, base, "en", "a", 1), (2, base, "en", "b", 1), (2, base, "en", "b", 1), (3, base.replace("w", "W", 1), "en", "a", 1),
        (4, base + " one more word", "en", None, None), (5, None, "en", "a", None), (6, "", None, "a", 0), (7, " \n\t ", "en", "b", 4),
        (8, "one", "en", "b", 3), (9, "One two", "en", "a", 7), (10, "one two", "en", "a", 7), (11, prose(30000, 2), "en", "c", 1),
        (12, "\n".join(["The same long line of this text."] * 5), "en", "c", 1), (13, prose(120, 3), "en", "a", 1),
        (13, prose(120, 4), "en", "a", 1), (None, prose(90, 5), "en", "a", 1), (None, None, None, None, None),
        (14, "x " * 400, "en", "a", 1), (15, "Ünï cödé 👍 " * 80, "de", "a", 1), (16, base[:1500] + prose(60, 6), "en", "a", 1),
    ]
    line = "A line that stands in many of the documents here"
    return rows + [(100 + k, f"{prose(40, 50 + k)}\n  {line.upper() if k % 2 else line}\t\nend {k}", "en", "d", 1) for k in range(6)]


@pytest.fixture(scope="session")
def edge(spark):
    """The rows above, with further columns whose names operators use inside."""
    rows = [(*r, 1, 2, "k", "f", "h", "t", 3, 4) for r in edge_rows()]
    return importable(spark).createDataFrame(rows, f"{DOCUMENTS}, {EXTRA}").repartition(3)


@pytest.fixture(scope="session")
def nothing(spark):
    return importable(spark).createDataFrame([], f"{DOCUMENTS}, {EXTRA}")


@pytest.fixture(scope="session")
def documents(spark, sf_dir):
    return importable(spark).read.parquet(f"{sf_dir}/documents.parquet")


def pairs_of(df) -> list[tuple]:
    return [tuple(r) for r in df.select("doc_id", "text").collect()]


def bag(rows) -> list[tuple]:
    return sorted((tuple(r) for r in rows), key=repr)
