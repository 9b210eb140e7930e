"""The forest's inner loops in the JVM (ForestKernel.java).

The driver compiles the class with Janino, the compiler that Spark brings along for its own generated code, and adds
it to the session as a jar, so executors need nothing but Spark. Where there is no JVM to reach (or Janino can't be
used), ``kernels`` is None and the Python steps of ``forest`` do the same work, later.
"""

from __future__ import annotations

import logging
import os
import struct
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

log = logging.getLogger("airshed.native")

SOURCE, NAME = Path(__file__).with_name("ForestKernel.java"), "airshed.ForestKernel"
_KERNELS: dict = {}


class Kernels:
    def __init__(self, spark: SparkSession, made):
        self.spark, self.jvm, self.made = spark, spark.sparkContext._jvm, made

    def _step(self, step: str, setting: bytes):
        return self.made.newInstance(_objects(self.spark.sparkContext, step, setting))

    def _rows(self, ddl: str):
        return self.jvm.org.apache.spark.sql.Encoders.row(self.jvm.org.apache.spark.sql.types.StructType.fromDDL(ddl))

    def _grouped(self, df: DataFrame, keys: str):
        names = [k.split()[0] for k in keys.split(",")]
        # a condition without an else: keys of both sides of a cogroup must be nullable alike
        df = df.withColumns({k: F.when(F.col(k).isNotNull(), F.col(k)) for k in names})
        columns = self.spark.sparkContext._gateway.new_array(self.jvm.org.apache.spark.sql.Column, len(names))
        for i, k in enumerate(names):
            columns[i] = df[k]._jc
        return getattr(df._jdf.groupBy(columns), "as")(self._rows(keys), df._jdf.encoder())

    def rows(self, df: DataFrame, step: str, setting: bytes, ddl: str) -> DataFrame:
        """The rows that a step makes of each partition."""
        return DataFrame(df._jdf.mapPartitions(self._step(step, setting), self._rows(ddl)), self.spark)

    def groups(self, df: DataFrame, keys: str, step: str, setting: bytes, ddl: str) -> DataFrame:
        """The rows that a step makes of each group; ``keys`` in DDL."""
        return DataFrame(self._grouped(df, keys).flatMapGroups(self._step(step, setting), self._rows(ddl)), self.spark)

    def cogroups(self, df: DataFrame, other: DataFrame, keys: str, step: str, setting: bytes, ddl: str) -> DataFrame:
        """The rows that a step makes of the groups of two frames."""
        return DataFrame(self._grouped(df, keys).cogroup(self._grouped(other, keys), self._step(step, setting),
                                                         self._rows(ddl)), self.spark)


def kernels(spark: SparkSession) -> Kernels | None:
    app = spark.sparkContext.applicationId
    if app not in _KERNELS:
        try:
            _KERNELS[app] = _compiled(spark)
        except Exception as e:  # noqa: BLE001 - the Python steps make the same forest
            log.warning("the forest is made in Python: %s", e)
            _KERNELS[app] = None
    return None if _KERNELS[app] is None else Kernels(spark, _KERNELS[app])


def _compiled(spark: SparkSession):
    """The constructor of the class, which all executors have from now on."""
    sc = spark.sparkContext
    loader = spark._jsparkSession.getClass().getClassLoader()
    compiler = sc._jvm.org.codehaus.janino.SimpleCompiler()
    compiler.setParentClassLoader(loader)
    compiler.cook(SOURCE.read_text())
    jar = os.path.join(tempfile.mkdtemp(prefix="airshed-kernel-"), f"forest-kernel-{sc.applicationId}.jar")
    with zipfile.ZipFile(jar, "w") as z:
        for name, code in dict(compiler.getBytecodes()).items():
            z.writestr(name.replace(".", "/") + ".class", bytes(code))
    sc._jsc.sc().addJar(jar)
    urls = sc._gateway.new_array(sc._jvm.java.net.URL, 1)
    urls[0] = sc._jvm.java.io.File(jar).toURI().toURL()
    made = sc._jvm.java.net.URLClassLoader(urls, loader).loadClass(NAME).getConstructors()[0]
    made.newInstance(_objects(sc, "", b""))
    return made


def _objects(sc, *values):
    out = sc._gateway.new_array(sc._jvm.java.lang.Object, len(values))
    for i, v in enumerate(values):
        out[i] = v
    return out


def packed(features: int, trees: int, depth: int, min_leaf: int, bins: int, block: int, centre: float, cuts, chances,
           tops: dict, depths: dict | None = None, adds=None, open_nodes=(), copies: dict | None = None) -> bytes:
    """What a step is told, as ``ForestKernel.Setting`` reads it."""
    out = [struct.pack("<6id", features, trees, depth, min_leaf, bins, block, centre)]
    for x in [*cuts, chances]:
        out.append(struct.pack(f"<i{len(x)}d", len(x), *x))
    out.append(struct.pack("<i", len(tops)))
    for t, top in tops.items():
        deep = depths[t] if depths else []
        out.append(struct.pack("<iQi", t, adds(t) if adds else 0, len(top)) + top.tobytes()
                   + struct.pack(f"<i{len(deep)}i", len(deep), *deep))
    out.append(struct.pack("<i", len(open_nodes)) + b"".join(struct.pack("<2i", *x) for x in open_nodes))
    copies = copies or {}
    out.append(struct.pack("<i", len(copies)) + b"".join(struct.pack("<3i", *k, n) for k, n in copies.items()))
    return b"".join(out)
