"""Java of this subpackage as functions of a session: compiled by the Janino that Spark brings, sent out as a jar."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

#: Compilers by application and source file; they hold the driver's classes.
_COMPILED: dict[tuple[str, str], object] = {}


def _compiled(spark: SparkSession, source: str):
    context = spark.sparkContext
    key = context.applicationId, source
    if key not in _COMPILED:
        compiler = context._jvm.org.codehaus.janino.SimpleCompiler()
        compiler.cook(Path(__file__).with_name(source).read_text())
        jar = os.path.join(os.path.realpath(tempfile.mkdtemp(prefix="rillsync-")), source.replace(".java", ".jar"))
        codes = compiler.getBytecodes()
        with zipfile.ZipFile(jar, "w", zipfile.ZIP_DEFLATED) as out:
            for name in codes:
                out.writestr(name.replace(".", "/") + ".class", bytes(codes[name]))
        context._jsc.addJar(jar)  # executors get it from the driver
        _COMPILED[key] = compiler
    return _COMPILED[key]


def register(spark: SparkSession, source: str, **functions: tuple[str, str]) -> None:
    """Register functions of a session by name: each a class in `source`, an UDF of Spark's Java API, and what it
    returns."""
    loader = _compiled(spark, source).getClassLoader()
    for name, (kind, returns) in functions.items():
        made = loader.loadClass(kind).getDeclaredConstructor(None).newInstance(None)
        spark._jsparkSession.udf().register(name, made, spark._jvm.org.apache.spark.sql.types.DataType.fromDDL(returns))
