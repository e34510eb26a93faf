from __future__ import annotations

import random

import pytest


@pytest.fixture(scope="session")
def sc_dir(spark, tmp_path_factory):
    """A shared folder where the session has none."""
    if not spark.conf.get("spark.checkpoint.dir", None):
        spark.conf.set("spark.checkpoint.dir", f"file://{tmp_path_factory.mktemp('shared')}")
    return spark.conf.get("spark.checkpoint.dir")


@pytest.fixture(autouse=True)
def _shared(sc_dir):
    return sc_dir


def prose(rng: random.Random, n: int, words: int = 4000) -> str:
    return " ".join(f"w{rng.randrange(words)}" for _ in range(n))


@pytest.fixture(scope="session")
def corpus() -> list[tuple[int | None, str | None]]:
    """Copies, near copies, a passage that many share, short, empty, null and very long texts, odd white space and bytes."""
    rng = random.Random(5)
    base = [prose(rng, rng.randrange(5, 200)) for _ in range(60)]
    passage = prose(rng, 60)
    out = list(base)
    out += [base[1]] * 4 + [base[7].upper(), base[7].replace(" ", "\n\t ")]
    for i in range(40):
        w = base[3].split()
        if i:
            w[i * len(w) // 41] = f"edit{i}"
        out.append(" ".join(w))
    out += [f"{prose(rng, 30)} {passage} {prose(rng, 20)}" for _ in range(40)]
    out += [prose(rng, 6000), "a", "a b", "a  b", "", "  \n ", "x " * 300, "ab" * 700, "naïve — “quote” é́ 😀 " * 40, "\x00nul\x00 byte " * 30, None, None]
    rows = list(enumerate(out))
    rng.shuffle(rows)
    return rows


@pytest.fixture(scope="session")
def docs(spark, corpus):
    """The corpus with the columns of documents and columns whose names operators use inside."""
    rows = [(i, t, None if i is None or i % 7 == 0 else "en", "src0" if i % 3 else f"src{i % 5}", len(t or ""), i, "x") for i, t in corpus]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, block int, bucket string").repartition(3)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long, block int, bucket string")
