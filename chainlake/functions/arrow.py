"""Column functions that the JVM has no counterpart for, over Arrow batches."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def hash160(data: Column) -> Column:
    """RIPEMD-160 of SHA-256, as binary."""
    from ..sources import codec

    return F.pandas_udf(lambda x: x.map(lambda b: None if b is None else codec.hash160(bytes(b))), "binary")(data)


def script_kind(script: Column) -> Column:
    """(script_type, address_hash) of an output script."""
    from ..sources import codec

    def run(scripts: pd.Series) -> pd.DataFrame:
        found = [(None, None) if s is None else codec.classify(bytes(s)) for s in scripts]
        return pd.DataFrame(found, columns=["script_type", "address_hash"])

    return F.pandas_udf(run, "script_type int, address_hash binary")(script)
