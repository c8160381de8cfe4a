"""Memory of Python workers, which stay for the next task and beside the next stage, and of the driver."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from contextlib import suppress
from functools import wraps

import pyarrow as pa
from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

Batches = Iterator[pa.RecordBatch]


def let_go() -> None:
    """Give memory that is free back to the system: an allocator keeps it, so an idle worker is as large as its largest task was."""
    pa.default_memory_pool().release_unused()
    with suppress(OSError, AttributeError):  # allocators other than glibc's have no such call
        ctypes.CDLL(None).malloc_trim(0)


def let_driver_go(spark: SparkSession) -> None:
    """The same for the driver. Its JVM takes and frees memory outside the heap in hundreds of threads, by the compiler above all.

    glibc keeps what each has freed, so without this a long session's driver outgrows its heap by more and more, whatever the input.
    """
    let_go()
    jvm, gateway = spark._jvm, spark.sparkContext._gateway
    beans = jvm.java.lang.management.ManagementFactory.getPlatformMBeanServer()
    # By its interface, since the class of the server itself is in a closed package.
    (call,) = [m for m in jvm.java.lang.Class.forName("javax.management.MBeanServer").getMethods() if m.getName() == "invoke"]
    asked = gateway.new_array(jvm.java.lang.Object, 4)
    asked[0], asked[1] = jvm.javax.management.ObjectName("com.sun.management:type=DiagnosticCommand"), "systemTrimNativeHeap"
    asked[2], asked[3] = gateway.new_array(jvm.java.lang.Object, 0), gateway.new_array(jvm.java.lang.String, 0)
    with suppress(Py4JJavaError):  # JVMs before 17.0.9, and those of other systems, have no such command
        call.invoke(beans, asked)


def letting_go(run: Callable[[Batches], Batches]) -> Callable[[Batches], Batches]:
    """``run`` over a task's batches, its memory given back when the task has had its last batch."""
    @wraps(run)
    def wrapped(batches: Batches) -> Batches:
        yield from run(batches)
        let_go()

    return wrapped
