"""A listing is made and read some entries at a time, whatever the number of files."""

import tracemalloc

from partwise.streaming import listing
from partwise.streaming.listing import ListingReader

N = 200_000


def made_up(n):
    return ((f"/data/incoming/bucket/en/{i}.txt", i, 10**18 + i) for i in range(n))


def peak_mb(run):
    tracemalloc.start()
    run()
    top = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    return top / 1e6


def test_memory_of_a_large_listing(tmp_path, monkeypatch):
    """all rows of a listing were held at once, and a set of numbers of all files."""
    reader, log = ListingReader(str(tmp_path), str(tmp_path / "log")), str(tmp_path / "log")
    monkeypatch.setattr(ListingReader, "_listed", lambda self: made_up(N))
    assert peak_mb(reader.latestOffset) < 40
    assert reader.position == N and reader.latestOffset() == {"position": N}
    again = ListingReader(str(tmp_path), log)
    assert peak_mb(again._load) < 40
    monkeypatch.setattr(ListingReader, "_listed", lambda self: made_up(N + 3))
    assert again.latestOffset() == {"position": N + 3}
    rows = [r for p in again.partitions({"position": N - 2}, {"position": N + 3}) for b in again.read(p) for r in b.to_pylist()]
    assert {r["size"] for r in rows} >= {N, N + 1, N + 2} and len(rows) == 5


def test_every_file_once_in_chunks(tmp_path, monkeypatch):
    monkeypatch.setattr(listing, "AT_ONCE", 3)
    base = tmp_path / "in"
    for i in range(20):
        (base / f"d{i % 4}").mkdir(parents=True, exist_ok=True)
        (base / f"d{i % 4}" / str(i)).write_bytes(b"x" * i)
    reader = ListingReader(str(base), str(tmp_path / "log"))
    end = reader.latestOffset()
    rows = [r for p in reader.partitions({"position": 0}, end) for b in reader.read(p) for r in b.to_pylist()]
    assert sorted(r["size"] for r in rows) == list(range(20)) and end == {"position": 20}
    (base / "d1" / "1").write_bytes(b"x" * 100)
    assert reader.latestOffset() == {"position": 21}
