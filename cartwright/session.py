"""Session settings the warehouse plans rely on, and the driver's memory between them."""

from __future__ import annotations

from py4j.protocol import Py4JError
from pyspark.sql import SparkSession

# A wide rule projection fused with its scan and joins becomes one method beyond the
# size the JVM compiles, and would then run interpreted for every row.  With this limit
# Spark evaluates such a stage through split, compilable projections instead.
RUNTIME_SETTINGS = {"spark.sql.codegen.hugeMethodLimit": "8000"}


def prepare(spark: SparkSession) -> SparkSession:
    for name, value in RUNTIME_SETTINGS.items():
        spark.conf.set(name, value)
    return spark


def give_back(spark: SparkSession) -> bool:
    """Hand what the driver's JVM has freed outside its heap back to the system; False if this JVM has no command for it.

    Planning and compiling a layer's jobs takes such memory, and the C library keeps it thread by thread after use.
    """
    jvm, array = spark._jvm, spark.sparkContext._gateway.new_array
    names = ("javax.management.ObjectName", "java.lang.String", "[Ljava.lang.Object;", "[Ljava.lang.String;")
    types, values = array(jvm.java.lang.Class, len(names)), array(jvm.java.lang.Object, len(names))
    try:
        for position, name in enumerate(names):
            types[position] = jvm.java.lang.Class.forName(name)
        # By the interface: the server's own class is closed to callers.
        invoke = jvm.java.lang.Class.forName("javax.management.MBeanServerConnection").getMethod("invoke", types)
        values[0], values[1] = jvm.javax.management.ObjectName("com.sun.management:type=DiagnosticCommand"), "systemTrimNativeHeap"
        invoke.invoke(jvm.java.lang.management.ManagementFactory.getPlatformMBeanServer(), values)
    except Py4JError:
        return False
    return True
