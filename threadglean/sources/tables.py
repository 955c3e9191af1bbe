"""Stored tables: Parquet folders with declared schemas.

A table is `<root>/<name>/v=<n>`; readers use the highest finished version.
Appending adds files to it; replacing writes the next one, so a plan never
overwrites what it reads. Replacing some folders of a version is written aside first, as
`<root>/<name>/pending`: after a crash in between, the next access puts it in place.
"""

from functools import reduce

from pyspark.sql import functions as F

from threadglean.operators.merge import merge_keyed, one_per_key
from threadglean.operators.scale import narrow_to
from threadglean.schemas import KEYS, PARTITIONS, TABLES


class DuplicateKey(ValueError):
    """An append would store a key twice."""


class Tables:
    def __init__(self, spark, root):
        self.spark = spark
        self.root = root.rstrip("/")

    def _fs(self, path):
        jvm = self.spark._jvm
        hpath = jvm.org.apache.hadoop.fs.Path(path)
        return hpath.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf()), hpath

    def _versions(self, name):
        fs, path = self._fs(f"{self.root}/{name}")
        if not fs.exists(path):
            return []
        numbers = []
        for status in fs.listStatus(path):
            version = status.getPath()
            done = self.spark._jvm.org.apache.hadoop.fs.Path(version, "_SUCCESS")
            if version.getName().startswith("v=") and fs.exists(done):
                numbers.append(int(version.getName()[2:]))
        return sorted(numbers)

    def path(self, name):
        """Folder of the current version, None while the table has no data."""
        versions = self._versions(name)
        return f"{self.root}/{name}/v={versions[-1]}" if versions else None

    def read(self, name, since=None, where=None):
        """The table, empty if it does not exist yet. `since` (a time) leaves out
        the day folders before it, and rows without a time; `where` is a condition
        on folder columns."""
        self._recover(name)
        path, schema = self.path(name), TABLES[name]
        if path is None:
            return self.spark.createDataFrame([], schema)
        df = self.spark.read.schema(schema).parquet(path)
        if since is not None:
            df = df.where(F.col("created_day") >= F.to_date(F.lit(since)))
        if where is not None:
            df = df.where(where)
        return df.select(*schema.names)

    def _folders(self, path):
        """Names (column=value) of the folders in a folder."""
        fs, hpath = self._fs(path)
        names = [s.getPath().getName() for s in fs.listStatus(hpath) if s.isDirectory()]
        return [n for n in names if "=" in n and not n.endswith("=__HIVE_DEFAULT_PARTITION__")]

    def read_last(self, name):
        """The rows in the last day folder, of each community where these come first: all
        that a largest time needs. Only folder names are listed for that."""
        path, columns = self.path(name), list(PARTITIONS.get(name, {}))
        if path is None:
            return self.read(name)
        tops = [path] if len(columns) == 1 else [f"{path}/{n}" for n in self._folders(path)]
        last = []
        for top in tops:
            days = self._folders(top)
            if days:
                day = F.col(columns[-1]) == F.lit(max(days).split("=", 1)[1]).cast("date")
                last.append(day if len(columns) == 1 else
                            (F.col(columns[0]) == top.rsplit("=", 1)[1]) & day)
        return self.read(name, where=reduce(lambda a, b: a | b, last) if last else F.lit(False))

    def drop_old_versions(self, name, keep=2):
        """Delete all but the newest `keep` finished versions."""
        for number in self._versions(name)[:-keep]:
            fs, path = self._fs(f"{self.root}/{name}/v={number}")
            fs.delete(path, True)

    def create_missing(self):
        """Store an empty table for every declared one that does not exist."""
        for name in TABLES:
            if self.path(name) is None:
                self.replace(name, self.read(name))

    def _write(self, df, name, path, mode, **options):
        schema, folders = TABLES[name], PARTITIONS.get(name, {})
        rows = df.select(*[F.col(f.name).cast(f.dataType) for f in schema.fields])
        rows = rows.withColumns({c: F.expr(e) for c, e in folders.items() if c not in schema.names})
        if folders:
            # Few files per folder, and a folder with most rows still many tasks.
            rows = rows.hint("rebalance", *folders)
        writer = rows.write.mode(mode).options(**options)
        if folders:
            writer = writer.partitionBy(*folders)
        writer.parquet(path)

    def append(self, name, df, check_key=True):
        """Add rows; a null or repeated key, or one already stored, is refused."""
        self._recover(name)
        if check_key and name in KEYS:
            self.check_key(name, df)
        self._write(df, name, self.path(name) or f"{self.root}/{name}/v=1", "append")

    def replace(self, name, df):
        versions = self._versions(name)
        number = versions[-1] + 1 if versions else 1
        self._write(df, name, f"{self.root}/{name}/v={number}", "overwrite",
                    partitionOverwriteMode="static")

    def replace_partitions(self, name, df):
        """Replace the folders that `df` has rows for; `df` holds all their rows."""
        self._recover(name)
        schema = TABLES[name]
        df.select(*[F.col(f.name).cast(f.dataType) for f in schema.fields]).write.mode("overwrite").parquet(
            f"{self.root}/{name}/pending")
        self._recover(name)

    def _recover(self, name):
        """Put folders that were written aside in place; done again after a crash, it gives
        the same folders."""
        pending = f"{self.root}/{name}/pending"
        fs, path = self._fs(pending)
        if not fs.exists(self.spark._jvm.org.apache.hadoop.fs.Path(path, "_SUCCESS")):
            return
        rows = self.spark.read.schema(TABLES[name]).parquet(pending)
        if not rows.isEmpty():
            self._write(rows, name, self.path(name), "overwrite", partitionOverwriteMode="dynamic")
        fs.delete(path, True)

    def upsert(self, name, batch, order):
        """Rows of the batch replace stored ones of their key, the others are added.

        Only buckets that hold a repeated key are rewritten. Of rows with one key the
        first in `order` is taken.
        """
        keys, (folder, bucket) = KEYS[name], next(iter(PARTITIONS[name].items()))
        new = one_per_key(batch, keys, order).select(*TABLES[name].names)
        repeated = narrow_to(self.read(name), new, keys).join(new.select(*keys), keys, "left_semi")
        touched = [r[0] for r in repeated.select(F.expr(bucket)).distinct().collect()]
        if touched:
            hit = F.expr(bucket).isin(touched)
            stored = self.read(name, where=F.col(folder).isin(touched))
            self.replace_partitions(name, merge_keyed(stored, new.where(hit), keys, "take_new", unique=True))
            new = new.where(~hit)
        self.append(name, new, check_key=False)

    def check_key(self, name, df):
        keys = KEYS[name]
        new = df.select(*keys)
        missing = new.where(~F.expr(" AND ".join(f"{k} IS NOT NULL" for k in keys)))
        twice = new.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1").select(*keys)
        stored = new.join(narrow_to(self.read(name).select(*keys), new, keys), keys, "left_semi")
        bad = missing.unionByName(twice).unionByName(stored).take(1)
        if bad:
            raise DuplicateKey(f"{name}: key {bad[0].asDict()} is null, repeated or stored")
