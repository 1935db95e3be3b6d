"""Operators whose workers cannot import this package: what is broadcast are plain values."""

import os
import subprocess
import sys
import textwrap

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def test_workers_find_no_package(tmp_path, sf_dir):
    """The driver alone has the package on its path, by sys.path; workers start in another folder without it."""
    script = tmp_path / "driver.py"
    script.write_text(textwrap.dedent(f"""
        import sys
        sys.path.append({ROOT!r})
        from pyspark.sql import SparkSession
        from pyspark.sql import functions as F
        spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false")
                 .config("spark.sql.shuffle.partitions", "2").getOrCreate())

        def there(batches):
            import importlib.util
            for batch in batches:
                found = importlib.util.find_spec("partwise") is not None
                yield batch.slice(0, 1).to_pandas().assign(id=int(found)).pipe(lambda f: __import__("pyarrow").RecordBatch.from_pandas(f))

        assert spark.range(1).mapInArrow(there, "id long").first()["id"] == 0, "workers have the package"
        from partwise.llm.decontaminate import find_contamination
        from partwise.llm.language_id import fit, with_language
        from partwise.llm.packing import pack_documents
        from partwise.llm.queries import vocabulary
        from partwise.llm.tables import read
        docs, bench = read(spark, {sf_dir!r}, "documents").limit(60), read(spark, {sf_dir!r}, "benchmark")
        assert with_language(docs, fit(docs)).count() == 60
        assert find_contamination(docs, bench).count() >= 0
        assert pack_documents(docs, vocabulary()).count() >= 60
        print("done")
    """))
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    kept = [p for p in os.environ.get("PYTHONPATH", "").split(os.pathsep) if p and os.path.abspath(p) != ROOT]
    if kept:
        env["PYTHONPATH"] = os.pathsep.join(kept)
    done = subprocess.run([sys.executable, str(script)], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert done.stdout.strip().endswith("done"), done.stderr[-3000:]
