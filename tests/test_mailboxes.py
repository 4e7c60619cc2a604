import os

from pyspark.sql import functions as F

from clipforge.plans.parsing import q_mail_scan
from clipforge.sources.mail import extract_blocks, read_mails, split_mailboxes, write_mailboxes


def test_mailboxes_keep_every_mail(spark, tmp_path):
    texts = {"a": "Subject: x\n\nFrom me\n>From you\nend", "b": "", "c": "Subject: \u00e9\u20ac\n\n\u2028From here\n"}
    write_mailboxes(spark.createDataFrame([*texts.items(), (None, "x"), ("d", None)], "path string, content string"), str(tmp_path / "box"))
    (tmp_path / "box" / "one.txt").write_bytes(b"Subject: y\n\nno envelope \xff")
    got = split_mailboxes(read_mails(spark, str(tmp_path / "box"), "*.txt")).collect()
    named = {r.path.rsplit("#", 1)[1]: bytes(r.content).decode() for r in got if "#" in r.path}
    assert {k: v.rstrip("\n") for k, v in named.items()} == {k: v.rstrip("\n") for k, v in texts.items()}
    assert [bytes(r.content) for r in got if "#" not in r.path] == [b"Subject: y\n\nno envelope \xff"]
    assert all(r.error is None for r in extract_blocks(split_mailboxes(read_mails(spark, str(tmp_path / "box"), "*.txt"))).collect())


def test_mail_scan_writes_few_files(spark, tmp_path):
    docs = spark.range(1, 401).select(F.col("id").alias("doc_id"), F.lit("s").alias("source"), F.concat(F.lit("Title "), "id", F.lit("\nFrom the text")).alias("text"))
    docs.coalesce(2).write.parquet(str(tmp_path / "documents.parquet"))
    kept = spark.sparkContext.getCheckpointDir()[5:]
    before = set(os.listdir(kept))
    rows = q_mail_scan(spark, str(tmp_path)).collect()
    files = [f for d in set(os.listdir(kept)) - before if d.startswith("mails-") for _, _, fs in os.walk(f"{kept}/{d}") for f in fs if f.endswith(".txt")]
    assert 1 <= len(files) <= 8                       # one per task, not one per mail
    dated = [n for n in range(1, 401) if n % 7 != 3 and n % 11 != 5 and n % 13 != 12 and n % 31 + 1 <= (31, 29, 31, 30, 31, 30, 31, 31, 30, 31, 30, 31)[n % 13]]
    assert sorted(r.mail for r in rows if r.error is None) == dated
    assert sorted(r.mail for r in rows if r.error) == [n for n in range(1, 401) if n % 7 != 3 and n % 11 == 5]
