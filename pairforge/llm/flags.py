"""Which keys of a document occur in other documents: one blob shuffle.

Every document brings a set of 64-bit keys.  A batch of documents is sorted
once: a key that several documents of the batch hold is settled there, and
only one entry of it leaves, so a key that a third of all documents hold
costs one entry per batch, not per document.  Entries travel as packed
arrays by key bucket; the number of buckets follows the number of keys.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairforge.llm.common import U64, id_array, list_column, list_values

#: keys that one bucket holds on average
BUCKET_KEYS = 400_000
#: keys that are sorted and packed at once
SLICE_KEYS = 1_000_000

_BLOBS = "bucket bigint, keys binary, owners binary, shared binary"
_OUT = "doc_id bigint, keys array<bigint>"
_FLAT = "doc_id bigint, key bigint"


def _pack(bucket: int, keys, owners, shared) -> dict:
    return {"bucket": bucket, "keys": keys.tobytes(), "owners": owners.tobytes(), "shared": shared.tobytes()}


def _slices(batches):
    """(owners, keys) arrays of a bounded number of keys each."""
    owners, keys, held = [], [], 0
    for batch in batches:
        ids, col = id_array(batch.column("doc_id")), batch.column("keys")
        lengths, flat = list_values(col)
        owners.append(np.repeat(ids, lengths))
        keys.append(flat.view(U64))
        held += len(flat)
        if held >= SLICE_KEYS:
            yield np.concatenate(owners), np.concatenate(keys)
            owners, keys, held = [], [], 0
    if held:
        yield np.concatenate(owners), np.concatenate(keys)


def _sorted_runs(keys, owners):
    """Entries in order of (key, owner), the start of each key's run, each entry's run number."""
    order = np.lexsort((owners, keys))
    keys, owners = keys[order], owners[order]
    new = np.concatenate([[True], keys[1:] != keys[:-1]])
    return keys, owners, np.flatnonzero(new), np.cumsum(new) - 1, order


def _packer(buckets: int, later: bool):
    def pack(batches):
        for owners, keys in _slices(batches):
            keys, owners, starts, run, _ = _sorted_runs(keys, owners)
            first, last = owners[starts], owners[np.concatenate([starts[1:], [len(keys)]]) - 1]
            many = first != last
            settled = many[run] & (owners != first[run]) if later else many[run]
            rows = []
            if settled.any():  # known here already; bucket < 0: passed through
                rows.append(_pack(-1 - int(keys[0] % U64(buckets)), keys[settled], owners[settled],
                                  np.empty(0, dtype=np.uint8)))
            heads, owner, shared = keys[starts], first, many.astype(np.uint8)
            slot = ((heads >> U64(20)) % U64(buckets)).astype(np.int64)
            order = np.argsort(slot, kind="stable")
            edges = np.searchsorted(slot[order], np.arange(buckets + 1))
            for b in range(buckets):
                part = order[edges[b]:edges[b + 1]]
                if len(part):
                    rows.append(_pack(b, heads[part], owner[part], shared[part]))
            yield pa.RecordBatch.from_pylist(rows, schema=_BLOB_ARROW)
    return pack


_BLOB_ARROW = pa.schema([("bucket", pa.int64()), ("keys", pa.binary()), ("owners", pa.binary()),
                         ("shared", pa.binary())])


def _by_owner(keys, owners) -> pa.Table:
    order = np.argsort(owners, kind="stable")
    keys, owners = keys[order], owners[order]
    starts = np.flatnonzero(np.concatenate([[True], owners[1:] != owners[:-1]])) if len(owners) else np.empty(0, int)
    parts = np.split(keys, starts[1:]) if len(starts) else []
    return pa.table({"doc_id": pa.array(owners[starts], type=pa.int64()), "keys": list_column(parts)})


def _flat(keys, owners) -> pa.Table:
    return pa.table({"doc_id": pa.array(owners, type=pa.int64()), "key": pa.array(keys.view(np.int64))})


def _reducer(later: bool):
    give = _by_owner if later else _flat

    def reduce(table: pa.Table) -> pa.Table:
        def joined(name, dtype):
            return np.frombuffer(b"".join(table.column(name).to_pylist()), dtype=dtype)

        keys, owners = joined("keys", U64), joined("owners", np.int64)
        if not len(keys):
            return give(keys, owners)
        if table.column("bucket")[0].as_py() < 0:
            return give(keys, owners)
        keys, owners, starts, run, order = _sorted_runs(keys, owners)
        if later:
            hit = owners != owners[starts][run]
        else:
            shared = joined("shared", np.uint8)[order]
            several = owners[starts] != owners[np.concatenate([starts[1:], [len(keys)]]) - 1]
            hit = (several | (np.add.reduceat(shared, starts) > 0))[run] & (shared == 0)
        return give(keys[hit], owners[hit])
    return reduce


def flagged_keys(sets: DataFrame, n_keys: int, later: bool = False, made=None) -> DataFrame:
    """(doc_id, keys) of the keys that other documents hold as well.

    ``sets``: doc_id, keys array<bigint> (distinct keys per document, no
    nulls).  ``later=False``: each document's keys that any other document
    holds; ``later=True``: only those that a document with a smaller doc_id
    holds.  ``n_keys``: about how many keys there are (sets the number of
    buckets).  Documents without such a key have no row.

    ``made``: makes batches of (doc_id, keys) from those of ``sets`` in the worker
    that packs them; as a step of its own it would hold a second worker per task.
    """
    buckets = max(12, n_keys // BUCKET_KEYS)
    pack = _packer(buckets, later)
    if made is None:
        blobs = sets.select("doc_id", "keys").mapInArrow(pack, _BLOBS)
    else:
        blobs = sets.mapInArrow(lambda batches: pack(made(batches)), _BLOBS)
    parts = blobs.groupBy("bucket").applyInArrow(_reducer(later), _OUT if later else _FLAT)
    keys = F.flatten(F.collect_list("keys")) if later else F.collect_list("key")
    return parts.groupBy("doc_id").agg(keys.alias("keys"))
