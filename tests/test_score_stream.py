"""A stream's scores are those of the batch operators over the same days, whatever the batches and their repeats."""

from pyspark.sql import functions as F

from sigweave.operators import cluster, tables
from sigweave.plans import made
from sigweave.streaming import corroboration

DDL = "seq long, sourceSlug string, sourceName string, title string, summary string, category string, publishedAt string, externalId string, day string, rawMeta struct<dateInferred: boolean>"


def row(seq, slug, title, day):
    return (seq, slug, slug.title(), title, "A summary.", "racing", f"{day}T05:00:00.000Z", str(seq), day, (False,))


def test_days_equal_the_batch(spark, tmp_path):
    parts = [
        [row(1, "motogp-news", "Honda shows a bike", "2024-01-01"), row(2, "visordown", "Rain over the track today", "2024-01-01")],
        [row(3, "visordown", "Honda again in the news", "2024-01-03"), row(4, "eicma", "A fair without makers", "2024-01-08")],
        [row(5, "cycleworld", "Honda a day late", "2024-01-02"), row(6, "eicma", "Honda at the fair", "2024-01-03")],
    ]
    source, folder = tmp_path / "in", str(tmp_path / "out")
    for i, part in enumerate(parts):
        spark.createDataFrame(part, DDL).coalesce(1).write.parquet(f"{source}/{i}")
    stream = lambda: spark.readStream.schema(DDL).option("recursiveFileLookup", True).option("maxFilesPerTrigger", 1).parquet(str(source))
    corroboration.score_stream(stream(), folder).awaitTermination()
    seen = lambda: sorted((r.seq, r.cluster_size, r.confidence, r.heat) for r in spark.read.option("recursiveFileLookup", True).parquet(f"{folder}/scored").collect())
    every = spark.createDataFrame([r for part in parts for r in part], DDL)
    want = sorted((r.seq, r.cluster_size, r.confidence, r.heat) for d in ("2024-01-01", "2024-01-02", "2024-01-03", "2024-01-08") for r in corroboration.scored_day(every, d).collect())
    first = seen()
    assert first == want and {r[0]: r[1] for r in want} == {1: 1, 2: 1, 5: 2, 3: 4, 6: 4, 4: 1}
    # the last batch once more, as after a crash between its work and the record of it
    (last,) = [p for p in (tmp_path / "out" / "checkpoint" / "commits").iterdir() if p.name == "2"]
    last.unlink()
    last.with_name(".2.crc").unlink(missing_ok=True)
    corroboration.score_stream(stream(), folder).awaitTermination()
    assert seen() == first


def test_release(spark):
    kept = tables.stored(spark.range(3), "x")
    assert kept.count() == 3
    tables.release(spark)
    again = tables.stored(spark.range(2).select(F.col("id")), "x")
    assert again.count() == 2


def test_scores_write_no_texts_and_know_rows_beyond_a_million(spark, tmp_path, monkeypatch):
    """Document 1,000,000 is not the earlier one of id 0; titles and summaries go to no table on the way."""
    rows = [(0, "alpha beta gamma\nx"), (1, "alpha beta gamma\ny"), (2, "another title of three words"), (1_000_000, "delta epsilon zeta eta"), (1_000_001, "delta epsilon zeta eta"), (1_000_002, "delta epsilon zeta eta")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    wrote = []
    monkeypatch.setattr(cluster, "stored", lambda df, tag: wrote.extend(df.columns) or tables.stored(df, tag))
    got = sorted((r.seq, r.cluster_id, r.cluster_size) for r in made.scored_with_context(spark, str(tmp_path)).collect())
    assert got == [(1, 1, 2), (2, 2, 1), (1_000_000, 1_000_000, 3), (1_000_001, 1_000_000, 3)]
    assert wrote and not {"title", "summary"} & {*wrote}
