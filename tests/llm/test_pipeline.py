"""The pipeline's stages one by one against brute force, each on what its predecessor kept."""

import hashlib
import os
import subprocess
import sys

import public_tokenizers
import pyarrow as pa
from pyspark.sql import functions as F
from test_decontaminate import brute as brute_items
from test_jaccard_join import brute as brute_groups
from test_line_dedup import expected as expected_lines
from tokenizers import Tokenizer

import corpus_pipeline
from kempt.llm import decontaminate, frames
from kempt.operators.staging import collecting, release, staging_root


def texts(df):
    return [(r["doc_id"], r["text"]) for r in df.collect()]


def test_stages(spark, folder, tmp_path):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["language_id", "line_dedup", "ngram_jaccard_join", "benchmark_decontamination", "bpe"]
    columns = docs.columns

    def go(name, df):
        out = stages[name](spark, df, folder)
        out.write.parquet(str(tmp_path / name))
        return spark.read.parquet(str(tmp_path / name))

    one = go("language_id", docs)
    assert one.columns == columns and one.count() >= 0.99 * docs.count()
    two = go("line_dedup", one)
    before, left = dict(texts(one)), expected_lines(texts(one), 50)
    # Documents that this stage has emptied itself are gone, and no others.
    assert two.columns == columns and dict(texts(two)) == {k: t for k, t in left.items() if t != "" or before[k] == ""}
    assert any(t == "" and before[k] != "" for k, t in left.items())
    assert all(r["n_chars"] == len(r["text"]) for r in two.collect())
    three = go("ngram_jaccard_join", two)
    assert three.columns == columns
    assert sorted(k for k, _ in texts(three)) == [k for k, _, c in brute_groups(texts(two)) if k == c]
    four = go("benchmark_decontamination", three)
    items = texts(spark.read.parquet(f"{folder}/benchmark.parquet").withColumnRenamed("item_id", "doc_id"))
    gone = {k for k, _ in texts(three)} - {k for k, _ in texts(four)}
    whole = {k for k, t in texts(three) for _, i in items if decontaminate.normalized(i) in decontaminate.normalized(t)}
    short = [(k, t) for k, t in texts(three) if len(t) < 450][:15]
    assert four.columns == columns and whole <= gone
    assert {k for k, _ in brute_items(short, items)} == gone & dict(short).keys()
    five = go("bpe", four)
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    rows = {r["doc_id"]: r for r in five.collect()}
    assert len(rows) == four.count()
    for k, t in texts(four):
        ids = library.encode(t, add_special_tokens=False).ids
        assert rows[k]["n_tokens"] == len(ids)
        assert rows[k]["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
    assert sorted(map(tuple, corpus_pipeline.run(spark, folder).collect())) == sorted(map(tuple, five.collect()))


def test_only_the_last_result_stays(spark, folder):
    with collecting() as earlier:
        assert corpus_pipeline.run(spark, folder).count()
    stays = {p.rpartition("/")[2] for p in earlier} & set(os.listdir(staging_root(spark)))
    assert {t.rpartition("-")[0] for t in stays} == {"pipeline-bpe"}
    release(spark, earlier)


def test_registered_with_the_operators():
    import __spark_entry__ as entry

    names = entry.queries()
    assert "pipeline" in names and all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 11))
    assert not [n for n in entry.oracle_sql() if n not in names]


def test_the_rest_never_imports_this_package():
    code = (
        "import sys, __spark_entry__ as e; import pkgutil, kempt, importlib\n"
        "assert 'kempt.llm.queries' in sys.modules\n"
        "for m in [m for m in sys.modules if m.startswith('kempt.llm') or m == 'corpus_pipeline']: del sys.modules[m]\n"
        "[importlib.import_module(m.name) for m in pkgutil.walk_packages(kempt.__path__, 'kempt.') if not m.name.startswith('kempt.llm')]\n"
        "import queries.catalog, queries.oracle\n"
        "assert not [m for m in sys.modules if m.startswith('kempt.llm.')]"
    )
    subprocess.run([sys.executable, "-c", code], check=True, cwd=corpus_pipeline.__file__.rpartition("/")[0])


def test_batches_are_bounded_by_bytes(spark):
    docs = spark.range(0, 300, 1, 1).select(F.col("id").alias("doc_id"), F.repeat(F.lit("x"), 100_000).alias("text"))

    def sizes(batches):
        for batch in batches:
            yield pa.record_batch({"rows": pa.array([batch.num_rows], pa.int64()), "size": pa.array([batch.nbytes], pa.int64())})

    found = frames.map_texts(docs, "rows bigint, size bigint", sizes).collect()
    assert sum(r["rows"] for r in found) == 300
    assert max(r["size"] for r in found) <= 2 * frames.BATCH_BYTES
    # A size that the session names stays.
    own = spark.newSession()
    own.conf.set(frames.BATCH, 1 << 20)
    frames.map_texts(own.createDataFrame([(1, "a")], "doc_id int, text string"), "rows bigint, size bigint", sizes)
    assert own.conf.get(frames.BATCH) == str(1 << 20)
