"""Small tables in the item schemas, and the load applied one row at a time."""

from __future__ import annotations

from datetime import datetime, timedelta
from decimal import Decimal

from goldweave import schema as S

RUN_TS = datetime(2024, 1, 3, 10, 0)
USER = "loader"


def frame(spark, rows, schema):
    names = [f.name for f in schema.fields]
    unknown = {k for r in rows for k in r} - set(names)
    assert not unknown, unknown
    return spark.createDataFrame([tuple(r.get(c) for c in names) for r in rows], schema)


def feed_row(**values):
    row = {c: None for c in [*S.FEED_COLUMNS, "transaction_seq"]}
    row.update(sys_source="S1", sys_ent_state="ACTIVE", revision=" ")
    row.update(values)
    return row


def message(**values):
    row = {f.name: None for f in S.MESSAGE_SCHEMA.fields}
    row.update(values)
    return row


def master_row(**values):
    row = {c: None for c in S.MASTER_COLUMNS}
    row.update(revision=" ", sys_creation_date=datetime(2020, 1, 1), sys_created_by="old")
    row.update(values)
    return row


def parse(text):
    if text in (None, ""):
        return None
    stamp, offset = text.rsplit(" ", 1)
    sign = -1 if offset[0] == "-" else 1
    hours, minutes = offset[1:].split(":")
    moment = datetime.strptime(stamp, "%Y-%m-%d %H:%M:%S")
    return moment - sign * timedelta(hours=int(hours), minutes=int(minutes))


def normal(row):
    out = {c: row[c] for c in S.FEED_COLUMNS}
    for c in S.OFFSET_DATES:
        out[c] = parse(out[c])
    for c in S.TRIMMED:
        out[c] = (out[c] or "").strip(" ") or None
    return out


def rank(row, columns):
    return tuple((row[c] is not None, "" if row[c] is None else row[c]) for c in columns)


def merge_one(master, row, keys, update, insert):
    hits = [m for m in master if all(m[k] == row[k] and row[k] is not None for k in keys)]
    for m in hits:
        m.update({c: row[c] for c in update})
    if not hits and insert:
        master.append({c: row[c] if c in insert else None for c in S.MASTER_COLUMNS})
    return bool(hits)


def message_columns_order():
    payload = list(dict.fromkeys([*S.MESSAGE_INSERT, *S.MESSAGE_UPDATE]))
    fixed = {*S.KEYS, "item_type", "sys_ent_state", "sys_created_by", "sys_last_modified_by",
             *S.STAMPS}
    return [c for c in payload if c not in fixed]


def feed_columns_order(update, insert):
    payload = list(dict.fromkeys([*insert, *update]))
    return [c for c in payload if c not in S.KEYS and c not in S.STAMPS]


def load(master, feed, messages, windows, source="S1", mode="A", delete=True, run_ts=RUN_TS):
    """The load, one row and one window at a time. ``windows`` is a list of (start, end)."""
    master = [dict(m) for m in master]
    if mode == "A":
        for start, end in windows:
            best = {}
            for x in messages:
                if x["item"] is None or x["seq_num"] is None:
                    continue
                if start <= x["sys_creation_date"] <= end:
                    best[x["item"]] = max(best.get(x["item"], x["seq_num"]), x["seq_num"])
            rows = []
            for x in messages:
                if x["item"] is not None and best.get(x["item"]) is not None and x["seq_num"] == best[x["item"]]:
                    row = {b: x[a] for a, b in S.MESSAGE_TO_MASTER.items()}
                    row.update(
                        revision=" ", name=row["description"], item_type="PART",
                        sys_ent_state="ACTIVE", sys_created_by=USER, sys_last_modified_by=USER,
                        sys_creation_date=run_ts, sys_last_modified_date=run_ts,
                    )
                    rows.append(row)
            for row in sorted(rows, key=lambda r: rank(r, message_columns_order())):
                merge_one(master, row, S.KEYS, S.MESSAGE_UPDATE, S.MESSAGE_INSERT)
    update, insert = {
        "A": (S.FEED_A_UPDATE, S.FEED_A_INSERT),
        "B": (S.FEED_B_UPDATE, S.FEED_B_INSERT),
        "C": ([], S.FEED_C_INSERT),
    }[mode]
    mine = [f for f in feed if f["sys_source"] == source]
    rows = [normal(f) for f in mine if f["item_id"] is not None and f["revision"] is not None]
    for row in sorted(rows, key=lambda r: rank(r, feed_columns_order(update, insert))):
        row.update(sys_creation_date=run_ts, sys_last_modified_date=run_ts)
        merge_one(master, row, S.KEYS, update, insert)
    for f in sorted(mine, key=lambda r: rank(r, ["is_emc"])):
        for m in master:
            if m["item_id"] == f["item_id"]:
                m.update(is_emc=f["is_emc"], sys_source=source, sys_last_modified_date=run_ts)
    if delete:
        for f in feed:
            if f["sys_ent_state"] == "DELETED":
                for m in master:
                    if m["item_id"] == f["item_id"] and m["revision"] == f["revision"]:
                        m.update(sys_ent_state="DELETED", sys_last_modified_date=run_ts)
    return master


def comparable(rows):
    def text(v):
        return str(v.normalize()) if isinstance(v, Decimal) else str(v)

    return sorted(tuple(text(r[c]) for c in S.MASTER_COLUMNS) for r in rows)
