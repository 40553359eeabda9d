"""Changed records in a stream: the last content of every id is the state, and only what differs from it comes out."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

CHANGES = "id bigint, seen bigint, hash string, before string"


def changes(records: DataFrame, id: str, seen: str, content: Sequence[str]) -> DataFrame:
    """(id, seen, hash, before) of every record of a stream whose content differs from that of the record of its id before it, and of the first
    of each id (before NULL). ``seen`` (bigint) puts the records of an id in order within a batch; a record that comes in a later batch is
    later. A content that an id had once and has again is a change. The state of an id is one hash, kept by Spark with the stream's
    checkpoint: a batch that runs again gives the same rows. Rows without id are left out."""
    content_hash = F.sha2(F.to_json(F.struct(*content), {"ignoreNullFields": "false"}), 256)
    rows = records.select(F.col(id).cast("bigint").alias("id"), F.col(seen).cast("bigint").alias("seen"), content_hash.alias("hash"))

    def step(key: tuple[int], parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        # the rows of an id in one batch: hashes only
        told = pd.concat(list(parts), ignore_index=True).sort_values(["seen", "hash"], kind="stable")
        last = state.get[0] if state.exists else None
        out = []
        for moment, digest in zip(told["seen"].tolist(), told["hash"].tolist()):
            if digest != last:
                out.append((key[0], moment, digest, last))
                last = digest
        state.update((last,))
        if out:
            yield pd.DataFrame(out, columns=["id", "seen", "hash", "before"])

    return rows.filter("id IS NOT NULL").groupBy("id").applyInPandasWithState(step, CHANGES, "hash string", "append", GroupStateTimeout.NoTimeout)
