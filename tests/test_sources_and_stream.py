import pytest
from pyspark.sql import functions as F

from quillspark.operators.cleaning import clean
from quillspark.operators.lexicon import last_wins, resolve_polarity
from quillspark.operators.vectors import parse_vectors
from quillspark.session import packed, shared_dir, spread, stage
from quillspark.sources import sinks, tables
from quillspark.streaming.cleaning import clean_stream


def write(path, text):
    path.write_text(text, encoding="utf-8")
    return str(path)


def test_load_data(spark, tmp_path):
    header = "id\ttext\tHS\tTR\tAG\n"
    write(tmp_path / "train_en.tsv", header + '1\t"say ""hi"" now"\t1\t0\t1\n2\tplain\t0\t0\t0\n')
    write(tmp_path / "dev_en.tsv", header + "3\tx\t0\t0\t0\n")
    write(tmp_path / "mine.tsv", header + "4\ty\t1\t1\t0\n")
    rows = tables.load_data(spark, "english", str(tmp_path), test_file="mine.tsv").orderBy("id").collect()
    assert [(r["id"], r["split"], r["language"]) for r in rows] == [
        (1, "train", "en"), (2, "train", "en"), (3, "validation", "en"), (4, "test", "en")]
    assert rows[0]["text"] == 'say "hi" now'
    for bad in ({"language": "french", "filepath": "x"}, {"language": "english"}):
        with pytest.raises(ValueError):
            tables.load_data(spark, **bad)


def test_lexicon_files(spark, tmp_path):
    slang = tables.read_slang(spark, write(tmp_path / "s.txt", "lol\t1\nwtf\t-2\nlol\t2\n"))
    assert {r["term"]: r["score"] for r in last_wins(slang).collect()} == {"lol": 2, "wtf": -2}
    stop = tables.read_stop_words(spark, write(tmp_path / "w.txt", "a\nthe\n"))
    assert [r["word"] for r in stop.collect()] == ["a", "the"]
    lines = tables.read_lines(spark, write(tmp_path / "p.txt", "feo\t1\tneg\nbien\t1\tpos\tpos\n"))
    assert {r["term"]: r["score"] for r in resolve_polarity(lines).collect()} == {"feo": -1, "bien": 1}
    emotions = tables.read_spanish_emotions(spark, write(tmp_path / "e.csv", "amor,joy,love\n"))
    assert tuple(emotions.first()) == ("amor", "joy", "love")
    vec = tables.read_lines(spark, write(tmp_path / "v.txt", "2 2\na 1 2\nb 3 4\na 5 6\n"))
    assert {r["word"]: r["vec"] for r in parse_vectors(vec, header=True).collect()} == {"a": [5.0, 6.0], "b": [3.0, 4.0]}
    translations = tables.read_translations(spark, write(tmp_path / "t.csv", 'id,other,translated_text\n7,x,"a, b"\n'))
    assert tuple(translations.first()) == (7, "a, b")


def test_strict_evaluation_files(spark, tmp_path):
    path = write(tmp_path / "g.tsv", "id\ttext\tHS\tTR\tAG\n1\tx\tone\t0\t0\n")
    with pytest.raises(Exception):
        tables.read_gold(spark, path).collect()


def test_prediction_folder_and_snapshot(spark, tmp_path):
    folder = str(tmp_path / "res")
    rows = spark.createDataFrame([(1, 1, 0, 1), (2, 0, 0, 0)], "id long, HS_prediction int, TR_prediction int, AG_prediction int")
    sinks.write_predictions(rows, folder, "en")
    sinks.write_predictions(rows.limit(1), folder, "es")
    got = tables.read_prediction_folder(spark, folder, "b").groupBy("language", "task").count().collect()
    assert sorted(tuple(r) for r in got) == [("en", "b", 2), ("es", "b", 1)]
    table = spark.createDataFrame([(1, "train", "a "), (2, "test", "")], "id long, split string, t string")
    sinks.save_snapshot(table, str(tmp_path / "snap"))
    back = sinks.load_snapshot(spark, str(tmp_path / "snap")).where("split = 'train'")
    assert back.select("t").first()["t"] == "a "
    sinks.write_translations(spark.createDataFrame([(1, "x, y")], "id long, translated_text string"), str(tmp_path / "tr"))
    assert tuple(tables.read_translations(spark, str(tmp_path / "tr")).first()) == (1, "x, y")


def test_stage_spread_and_packed(spark):
    table = stage(spark.range(10).repartition(4), "numbers")
    assert table.count() == 10
    assert spread(table.coalesce(1)).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    wide = spark.range(0, 10, 1, 32)
    assert spread(wide) is wide
    assert packed(wide, 8, 10).rdd.getNumPartitions() == 1
    assert packed(wide, 8, 10**9).rdd.getNumPartitions() == 32
    assert shared_dir(spark)


def test_stream_equals_batch(spark, tmp_path):
    rows = spark.createDataFrame([(1, "Hi @you #x !! http://a"), (2, "10:30 \U0001F642")], "id long, text string")
    rows.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in"))
    query = (
        clean_stream(stream).select("id", "cleaned_text").writeStream.format("memory").queryName("cleaned_rows")
        .option("checkpointLocation", str(tmp_path / "cp")).start()
    )
    query.processAllAvailable()
    query.stop()
    got = sorted(tuple(r) for r in spark.table("cleaned_rows").collect())
    assert got == sorted(tuple(r) for r in clean(rows).select("id", "cleaned_text").collect())
    with pytest.raises(ValueError):
        clean_stream(rows)


def test_filters_and_columns_reach_the_scan(spark, tmp_path):
    spark.createDataFrame([(1, "a", "en", 3)], "id long, text string, language string, other int").write.parquet(
        str(tmp_path / "t"))
    df = clean(spark.read.parquet(str(tmp_path / "t")).where(F.col("language") == "en")).select("id", "cleaned_text")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(language,en)" in plan and "Exchange" not in plan
    assert "ReadSchema: struct<id:bigint,text:string,language:string>" in plan
