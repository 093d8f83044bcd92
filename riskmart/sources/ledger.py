"""The columns a landed table has had, in versions: what may be added, and what is not let in.

``<root>/_schema_ledger/<table>`` holds a numbered JSON file per version. Every file must bring the required
columns, by default those of the first version; a later version adds columns, or gives one a wider type. A
delivery is judged against all of them:

* all required columns, nothing unknown: let in. Columns added meanwhile are null, so files
  of an old form may come late;
* the same and columns not seen before: let in, and a new version has them;
* a required column missing, a type that is not wider, no columns, or two of one name: not
  let in, whatever else is landed.

Names are compared without regard to case and spelt as they were first. One run lands a table at a
time; judging the same delivery again gives the same answer and no further version.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import SparkSession
from pyspark.sql import types as T

from riskmart.sources.files import _locate, child_names

LEDGER = "_schema_ledger"

INTEGERS = ("tinyint", "smallint", "int", "bigint")
REALS = ("float", "double")


def _is_wider(old: T.DataType, new: T.DataType) -> bool:
    """Whether every value of ``old`` is one of ``new``."""
    if old == new:
        return True
    for chain in (INTEGERS, REALS):
        if old.simpleString() in chain and new.simpleString() in chain:
            return chain.index(new.simpleString()) > chain.index(old.simpleString())
    if isinstance(old, T.DecimalType) and isinstance(new, T.DecimalType):
        return new.scale >= old.scale and new.precision - new.scale >= old.precision - old.scale
    return False


@dataclass(frozen=True)
class Verdict:
    """What became of a delivery's columns: the table's version after it, or why they were not let in."""

    version: int
    schema: T.StructType
    refusal: str | None = None


class Ledger:
    """The versions of one table under a landing root."""

    def __init__(self, spark: SparkSession, root: str, table: str, required: Sequence[str] | None = None):
        self.required = required
        self.spark, self.folder, self.table = spark, f"{root.rstrip('/')}/{LEDGER}/{table}", table

    def versions(self) -> list[T.StructType]:
        """The table's columns by version, oldest first."""
        names = [n for n in child_names(self.spark, self.folder) if n.endswith(".json")]
        return [self._read(n) for n in sorted(names, key=lambda n: int(n.removesuffix(".json")))]

    def current(self) -> T.StructType:
        known = self.versions()
        if not known:
            raise FileNotFoundError(f"no columns noted for {self.table}")
        return known[-1]

    def judge(self, schema: T.StructType) -> Verdict:
        """Let a delivery's columns in or not; nothing is noted yet."""
        known = self.versions()
        old = known[-1] if known else T.StructType([])
        version = len(known) - 1
        lower = [f.name.lower() for f in schema]
        if not lower or not all(n.strip() for n in lower):
            return Verdict(version, old, "a column without a name" if lower else "no columns")
        if len(set(lower)) < len(lower):
            return Verdict(version, old, "two columns of one name")
        required = self.required if self.required is not None else known[0].names if known else []
        missing = [n for n in required if n.lower() not in lower]
        if missing:
            return Verdict(version, old, f"missing {', '.join(missing)}")
        held = {f.name.lower(): i for i, f in enumerate(old)}
        fields = list(old.fields)
        for field in schema:
            at = held.get(field.name.lower())
            if at is None:
                fields.append(T.StructField(field.name, field.dataType))
            elif _is_wider(field.dataType, fields[at].dataType):
                continue  # a value of the table's type already
            elif _is_wider(fields[at].dataType, field.dataType):
                fields[at] = T.StructField(fields[at].name, field.dataType)
            else:
                was, now = fields[at].dataType.simpleString(), field.dataType.simpleString()
                return Verdict(version, old, f"{fields[at].name}: {now} instead of {was}")
        new = T.StructType(fields)
        return Verdict(version if new == old else version + 1, new)

    def admit(self, schema: T.StructType) -> Verdict:
        """Judge, and note a new version if there is one."""
        verdict = self.judge(schema)
        if verdict.refusal is None and verdict.version >= len(self.versions()):
            self._write(verdict)
        return verdict

    def _read(self, name: str) -> T.StructType:
        fs, where = _locate(self.spark, f"{self.folder}/{name}")
        stream = fs.open(where)
        try:
            data = bytes(self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toByteArray(stream))
        finally:
            stream.close()
        return T.StructType.fromJson(json.loads(data))

    def _write(self, verdict: Verdict) -> None:
        """Written aside and renamed, so that a version is there whole or not at all."""
        final = f"{self.folder}/{verdict.version}.json"
        fs, aside = _locate(self.spark, f"{self.folder}/_{verdict.version}.tmp")
        fs.mkdirs(aside.getParent())
        out = fs.create(aside, True)
        try:
            out.write(bytearray(json.dumps(verdict.schema.jsonValue()), "utf-8"))
        finally:
            out.close()
        if not fs.rename(aside, _locate(self.spark, final)[1]):
            raise OSError(f"could not write {final}")


def aligned(names: Sequence[str], schema: T.StructType) -> dict[str, str]:
    """The spelling in ``schema`` of each name of a delivery."""
    held = {f.name.lower(): f.name for f in schema}
    return {n: held[n.lower()] for n in names}
