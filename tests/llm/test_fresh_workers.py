"""What is sent to Python workers brings its imports along, whatever the worker ran before."""

import subprocess
import sys
from pathlib import Path

SCRIPT = """
import io
import sys
import pyarrow as pa
from pyspark import cloudpickle

run = cloudpickle.load(sys.stdin.buffer)
rows = pa.ipc.open_stream(io.BytesIO(sys.stdin.buffer.read())).read_all()
found = run(rows).to_pydict()
assert found == {"u": [1], "v": [2]}, found
"""


class Groups:
    """Stands for the frame of groups and keeps the function that would be sent."""

    def __getattr__(self, name):
        return lambda *args: self

    def applyInArrow(self, run, schema):
        return run


def test_blocks_of_large_groups_are_compared_in_a_worker_that_imported_nothing(spark):
    import pyarrow as pa
    from pyspark import cloudpickle

    from tidewell.llm import minhash

    run = minhash._settled(Groups(), Groups(), 85)
    # Rows come as a stream of batches, as they do from the JVM: making arrays of Python values imports pandas, and with it everything.
    rows = pa.table({"id": [1, 2, 1, 2], "is_x": [True, True, False, False], "members": [[1, 2, 3]] * 4})
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, rows.schema) as out:
        out.write_table(rows)
    root = str(Path(__file__).resolve().parents[2])
    sent = cloudpickle.dumps(run) + sink.getvalue().to_pybytes()
    done = subprocess.run([sys.executable, "-c", SCRIPT], input=sent, capture_output=True, cwd=root, timeout=120)
    assert done.returncode == 0, done.stderr.decode()
