"""What a task keeps in memory while it writes segments."""

import pyarrow as pa
from pyspark.sql import types as T

from partwise.sources.segments import write_segments


class _Rows:
    """Stands for a DataFrame: hands out the function that its tasks would run."""

    schema = T.StructType([T.StructField("upload_id", T.StringType()), T.StructField("bytes", T.BinaryType())])

    def mapInArrow(self, run, schema):
        return run


def test_waiting_rows_do_not_hold_their_bytes(tmp_path):
    """columns of a batch share its buffer, so 64 waiting batches of narrow rows held the bytes of all."""
    held = []

    def batches():
        for k in range(40):
            whole = pa.RecordBatch.from_pydict({"upload_id": [f"u{k}-{i}" for i in range(1000)], "bytes": [bytes([k]) * 2000] * 1000})
            yield pa.ipc.read_record_batch(whole.serialize(), whole.schema)
            del whole
            held.append(pa.total_allocated_bytes())

    before = pa.total_allocated_bytes()
    rows = pa.Table.from_batches(write_segments(_Rows(), str(tmp_path))(batches()))
    assert max(held) - before < 20_000_000  # of 80 MB in all
    assert rows.column_names == ["upload_id", "segment", "position", "stored"] and rows.num_rows == 40_000
    assert rows.column("upload_id").to_pylist() == [f"u{k}-{i}" for k in range(40) for i in range(1000)]
    for who, segment, position, stored in zip(*[rows.column(c).to_pylist()[::3999] for c in rows.column_names]):
        with open(tmp_path / segment, "rb") as f:
            f.seek(position)
            assert f.read(stored) == bytes([int(who[1:].split("-")[0])]) * 2000
