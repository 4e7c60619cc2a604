from clipforge.streaming.intake import start_intake
from tests.test_mail import HTML, write_mail


def test_intake_stream(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    write_mail(src / "Alert faculteit GEO - 1.eml", HTML)
    write_mail(src / "Alert faculteit GEO - 2.eml", HTML)   # same articles again: dropped as repeats
    blocked = spark.createDataFrame([("Nobody",)], "source string")
    q = start_intake(spark, str(src), str(tmp_path / "out"), str(tmp_path / "ckpt"), blocked_sources=blocked)
    q.awaitTermination(120)
    rows = spark.read.parquet(str(tmp_path / "out")).collect()
    # block 0 has a valid date; block 2 has an invalid one and is dropped
    assert len(rows) == 1
    assert rows[0].title == "Title & text" and rows[0].faculty == "GEO"


def test_old_articles_and_later_batches(spark, tmp_path):
    """A much older article still comes through; a repeat of an earlier batch does not."""
    src = tmp_path / "in"
    src.mkdir()
    run = lambda: start_intake(spark, str(src), str(tmp_path / "out"), str(tmp_path / "ckpt")).awaitTermination(120)
    write_mail(src / "Alert faculteit GEO - 1.eml", HTML)
    run()
    old = HTML.replace("Title", "Older").replace("2025", "2019").replace("2024", "2019")
    write_mail(src / "Alert faculteit GEO - 2.eml", old)
    write_mail(src / "Alert faculteit GEO - 3.eml", HTML)
    run()
    rows = spark.read.parquet(str(tmp_path / "out")).collect()
    assert sorted(r.title for r in rows) == ["Older & text", "Title & text"]


def test_repeats_are_known_without_the_written_articles(spark, tmp_path):
    """Each run writes to another folder: what it knows of earlier batches is the state alone."""
    src = tmp_path / "in"
    src.mkdir()
    run = lambda out: start_intake(spark, str(src), str(tmp_path / out), str(tmp_path / "ckpt")).awaitTermination(120)
    write_mail(src / "Alert faculteit GEO - 1.eml", HTML)
    run("a")
    write_mail(src / "Alert faculteit GEO - 2.eml", HTML)
    write_mail(src / "Alert faculteit GEO - 3.eml", HTML.replace("Title", "New"))
    run("b")
    titles = lambda out: [r.title for r in spark.read.parquet(str(tmp_path / out)).collect()]
    assert titles("a") == ["Title & text"] and titles("b") == ["New & text"]


def test_a_batch_run_again_writes_the_same(spark, tmp_path):
    """A batch whose commit is lost is run again from the state before it."""
    src = tmp_path / "in"
    src.mkdir()
    run = lambda: start_intake(spark, str(src), str(tmp_path / "out"), str(tmp_path / "ckpt")).awaitTermination(120)
    write_mail(src / "Alert faculteit GEO - 1.eml", HTML)
    run()
    write_mail(src / "Alert faculteit GEO - 2.eml", HTML.replace("Title", "New"))
    run()
    before = sorted(r.title for r in spark.read.parquet(str(tmp_path / "out")).collect())
    commits = sorted(p for p in (tmp_path / "ckpt" / "commits").iterdir() if p.name.isdigit())
    for p in (commits[-1], commits[-1].with_name(f".{commits[-1].name}.crc")):
        p.unlink(missing_ok=True)
    run()
    assert sorted(r.title for r in spark.read.parquet(str(tmp_path / "out")).collect()) == before == ["New & text", "Title & text"]
