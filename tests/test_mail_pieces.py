import pyarrow as pa

from clipforge.sources import mail


def test_rows_of_a_batch_come_in_pieces():
    batch = pa.RecordBatch.from_pydict({"path": [str(i) for i in range(1000)], "html": ["x"] * 1000})
    pieces = list(mail._in_pieces(iter([batch]), lambda path, html: [{"path": path, "block_no": 0}] * 2))
    assert max(p.num_rows for p in pieces) <= 2 * mail.PARSED_AT_ONCE
    assert [p for b in pieces for p in b.column("path").to_pylist()] == [str(i) for i in range(1000) for _ in "ab"]
