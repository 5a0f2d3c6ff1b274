"""Every stage of the pipeline, held against a plain version on its own input; and the registry."""

import hashlib
import random
import subprocess
import sys

import corpus_pipeline
import tiktoken
from fixtures import words
from test_decontaminate import plain as plain_hits
from test_quality import norm, verdicts
from test_simhash import plain_components, plain_print
from xxhash import xxh3_64_intdigest

from credlake.llm import bpe, queries
from credlake.llm.common import stored
from credlake.llm.op1_bpe import PATTERN, RANKS

REPO = corpus_pipeline.__file__.rpartition("/")[0]
KEY = lambda r: (r[0] is None, r[0] or 0, str(r))


def test_stages_equal_plain_versions(spark, sf, docs, tmp_path):
    table, frames = docs, []
    for number, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, table, sf).write.parquet(str(tmp_path / str(number)))
        frames.append(table)
        table = spark.read.parquet(str(tmp_path / str(number)))
        if number < len(corpus_pipeline.STAGES) - 1:
            assert table.columns == docs.columns, name
            assert table.where("n_chars <> length(text)").count() == 0
    quality, near, clean, private, coded = [f.collect() for f in [*frames[1:], table]]

    judged = verdicts([(r.source, r.text) for r in frames[0].collect()], 10, 0.02, 0.5)
    assert len(quality) == sum(kept for _, kept in judged)
    assert {r.text for r in quality} <= {r.text for r in frames[0].collect()}  # no line of the fixture is above a limit

    rows = [(r.doc_id, plain_print(r.text)) for r in quality]
    ids = {c for c in plain_components(rows) if c is not None}
    assert sorted(r.doc_id for r in near if r.doc_id is not None) == sorted(ids)

    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    want = [r for r in near if not ((h := plain_hits(r.text, items))[1] and 20 * len(h[1]) >= h[0])]
    assert sorted(map(KEY, want)) == sorted(map(KEY, clean)) and len(want) < len(near)

    assert sorted(map(KEY, private)) == sorted(map(KEY, clean))  # the fixture holds no personal data

    own = bpe.encoder(RANKS, PATTERN)
    library = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=own.vocabulary.ranks, special_tokens={})
    ids_of = sorted((KEY((r.doc_id,)), library.encode_ordinary(r.text)) for r in private)
    assert sorted((KEY((r.doc_id,)), [int.from_bytes(r.ids[i:i + 4], "little") for i in range(0, len(r.ids), 4)]) for r in coded) == ids_of
    assert {r.decoded_sha256 for r in coded} == {hashlib.sha256(r.text.encode()).hexdigest() for r in private}


def test_run_applies_all_stages(spark, sf):
    rows = corpus_pipeline.run(spark, sf).collect()
    assert rows and {"doc_id", "n_tokens", "ids", "ids_sha256", "decoded_sha256"} == set(rows[0].asDict())


def test_frequent_lines_leave_the_text(spark, sf):
    footer = "footer with words that every page of this host has"
    rows = [(i, f"page {i} says {i} things and {i} more " + " ".join(f"w{i}x{j}" for j in range(30)) + "\n" + footer, "en", "h", 0) for i in range(25)]
    rows.append((99, f"{footer}\n" + "few new words " * 1, "en", "h", 0))
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    out = corpus_pipeline.quality_stage(spark, df, sf).collect()
    assert len(out) == 25 and all(footer not in r.text and r.n_chars == len(r.text) for r in out)
    assert xxh3_64_intdigest(norm(footer).encode())  # the plain norm is the operator's


def test_a_group_of_near_copies_leaves_one(spark, sf):
    """300 copies of 20 lines, one word of each changed, amid 30 other documents of the host."""
    rng = random.Random(2)
    lines = [words(rng, 12, 10 ** 6).split() for _ in range(20)]
    rows = []
    for i in range(300):
        copy = [list(line) for line in lines]
        copy[rng.randrange(20)][rng.randrange(12)] = f"edit{i}"
        rows.append((i, "\n".join(map(" ".join, copy)), "en", "h", 0))
    rows += [(1000 + i, words(rng, 60, 10 ** 6) + "\n" + words(rng, 30, 10 ** 6), "en", "h", 0) for i in range(30)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    cleaned = stored(corpus_pipeline.quality_stage(spark, df, sf), "cleaned")
    assert cleaned.count() == 330
    texts = {i: t for i, t, *_ in rows}
    left = corpus_pipeline.near_duplicate_stage(spark, cleaned, sf).collect()
    assert all(r.text == texts[r.doc_id] for r in left)
    assert 1 <= sum(r.doc_id < 1000 for r in left) < 10 and sum(r.doc_id >= 1000 for r in left) == 30


def test_registry():
    numbers = sorted(int(n[2:n.index("_")]) for n in queries.QUERIES)
    assert numbers == list(range(1, 14))
    assert set(queries.ORACLES) <= set(queries.QUERIES)
    code = "import __spark_entry__ as e; assert {'pipeline', 'op1_byte_bpe'} <= set(e.queries()); assert set(e.oracle_sql()) <= set(e.queries())"
    subprocess.run([sys.executable, "-c", code], cwd=REPO, check=True)


def test_rest_imports_without_the_subpackage(tmp_path):
    import os
    import shutil
    shutil.copytree(f"{REPO}/credlake", tmp_path / "credlake", ignore=lambda d, names: ["llm"] if d.endswith("credlake") else ["__pycache__"])
    shutil.copy(f"{REPO}/__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; assert len(e.queries()) > 60 and not [n for n in e.queries() if n.startswith('op') or n == 'pipeline']"
    env = {**os.environ, "PYTHONPATH": ""}
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, env=env)
