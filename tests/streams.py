"""Replay of rows as a file stream, one file per micro-batch in the given order."""

import os
import tempfile

import pyarrow as pa
import pyarrow.parquet as pq


class Replay:
    def __init__(self, spark, schema):
        self.spark, self.schema = spark, schema
        self.folder = tempfile.mkdtemp(prefix="streamlab-test-")
        self.files = 0
        os.mkdir(f"{self.folder}/in")

    def add(self, pdf):
        self.files += 1
        path = f"{self.folder}/in/{self.files:04d}.parquet"
        table = pa.Table.from_pandas(pdf, preserve_index=False)
        pq.write_table(table, path, coerce_timestamps="us", allow_truncated_timestamps=True)
        os.utime(path, (1_000_000 + self.files, 1_000_000 + self.files))
        return self

    def stream(self):
        reader = self.spark.readStream.schema(self.schema).option("maxFilesPerTrigger", 1)
        return reader.parquet(f"{self.folder}/in")

    def run(self, build, mode="append", name="a"):
        """Run the stream built from the replay to its end; rows of the result as a DataFrame."""
        from streamlab.streaming.run import run_to_end

        out = f"{self.folder}/out-{name}"
        run_to_end(build(self.stream()), f"{self.folder}/check-{name}", out, mode)
        return self.spark.read.parquet(out)


def replay(spark, df, slices, order, sentinel=None):
    """Rows of ``df`` in ``order`` cut into slices; ``sentinel`` gives a last row far in the future."""
    pdf = df.toPandas().sort_values(list(order), ignore_index=True)
    result = Replay(spark, df.schema)
    step = -(-len(pdf) // slices)
    for i in range(0, len(pdf), step):
        result.add(pdf.iloc[i:i + step])
    for extra in sentinel or []:
        last = pdf.tail(1).copy()
        for column, value in extra.items():
            last[column] = value
        result.add(last)
    return result
