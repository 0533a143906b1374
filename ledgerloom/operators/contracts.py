"""Model contracts: declared column names and types, checked before any job runs.

``enforce_contract`` inspects ``df.schema`` only (analysis time, zero Spark
jobs): a missing column, an undeclared extra column or a type that cannot be
widened losslessly to the declared type raises :class:`ContractError`;
lossless widenings (``int -> bigint``, ``decimal(10,2) -> decimal(18,2)``) are
applied as casts so consumers always see the declared types.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ByteType, DataType, DecimalType, IntegerType, LongType, ShortType, StructType,
    _parse_datatype_string,
)

_INT_DIGITS = {ByteType: 3, ShortType: 5, IntegerType: 10, LongType: 19}


class ContractError(ValueError):
    pass


def _as_type(t: DataType | str) -> DataType:
    return _parse_datatype_string(t) if isinstance(t, str) else t


def widens_losslessly(actual: DataType, declared: DataType) -> bool:
    if actual == declared:
        return True
    a, d = type(actual), type(declared)
    if a in _INT_DIGITS and d in _INT_DIGITS:
        return _INT_DIGITS[a] <= _INT_DIGITS[d]
    if isinstance(actual, DecimalType) and isinstance(declared, DecimalType):
        return (declared.scale >= actual.scale
                and declared.precision - declared.scale >= actual.precision - actual.scale)
    if a in _INT_DIGITS and isinstance(declared, DecimalType):
        return declared.precision - declared.scale >= _INT_DIGITS[a]
    return False


def contract_diff(df: DataFrame, contract: Mapping[str, DataType | str] | StructType
                  ) -> dict[str, list]:
    """Schema-only comparison: ``missing``, ``extra``, ``mismatched``, ``widened``."""
    declared = ({f.name: f.dataType for f in contract.fields} if isinstance(contract, StructType)
                else {k: _as_type(v) for k, v in contract.items()})
    actual = {f.name: f.dataType for f in df.schema.fields}
    out = {"missing": [c for c in declared if c not in actual],
           "extra": [c for c in actual if c not in declared],
           "mismatched": [], "widened": []}
    for c, t in declared.items():
        if c in actual and actual[c] != t:
            key = "widened" if widens_losslessly(actual[c], t) else "mismatched"
            out[key].append((c, actual[c].simpleString(), t.simpleString()))
    return out


def enforce_contract(df: DataFrame, contract: Mapping[str, DataType | str] | StructType,
                     name: str = "model") -> DataFrame:
    diff = contract_diff(df, contract)
    problems = []
    if diff["missing"]:
        problems.append(f"missing columns {diff['missing']}")
    if diff["extra"]:
        problems.append(f"undeclared columns {diff['extra']}")
    if diff["mismatched"]:
        problems.append("type mismatch " + ", ".join(
            f"{c}: {a} is not {d}" for c, a, d in diff["mismatched"]))
    if problems:
        raise ContractError(f"contract of {name} violated: " + "; ".join(problems))
    declared = ({f.name: f.dataType for f in contract.fields} if isinstance(contract, StructType)
                else {k: _as_type(v) for k, v in contract.items()})
    return df.select(*[F.col(c).cast(t).alias(c) if df.schema[c].dataType != t else F.col(c)
                       for c, t in declared.items()])
