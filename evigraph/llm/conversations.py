"""Conversation structure repair by weighted CYK parsing (operator 12).

The roles of a repaired conversation read ``(s?(ua)+)?`` by their initials. A row can be kept (cost 0), given the role user or assistant
(3) or deleted (4); an empty row of a user or an assistant can be inserted anywhere (3). A row's first fault counts: blank
(no ``[^\\x20\\x09-\\x0D]``), duplicate (role and text seen earlier in the conversation), truncated (its last such character is not one of
``.!?``). Blank and duplicate rows must be deleted; a truncated row that stays costs 3 more.

The repair grammar is in Chomsky normal form over the states of that expression: a symbol [p>q] covers rows that lead from p to q, with
the rules [p>q] -> [p>r] [r>q], rows as terminals, and the insertion closure, the cheapest insertions that lead from p to q without
a row. A cell holds the least (cost, audit) of each symbol over a span of rows; audits are the initials of the edits (D, I, K, R). As
the rules can be regrouped at will, every split of a span gives the same cell, and spans of 1, 2, 4 ... rows, each from its
halves, suffice: first in blocks of BLOCK rows, then over the blocks of a conversation. No audit of a cell is the beginning of another
of the same cost, so the least audit of a span comes from the least audits of its parts.

Rows are put in order by turn (nulls first), then role, text (its first 32 characters and a digest); rows of one conversation may lie in
many partitions. A null conv_id is a conversation; null roles and texts are one space. Other columns are not read. Only the
repaired rows of one conversation pass through one task, as a stream, for their digest is sequential; an audit is a value of its row.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from .arrow import bounded_batches
from .storage import written

BLANKS = " \t\n\x0b\f\r"
BLOCK = 1024
#: How roles lead from state to state; a conversation ends in state 0 (empty) or 3.
STEPS = (("s", 0, 1), ("u", 0, 2), ("u", 1, 2), ("u", 3, 2), ("a", 2, 3))
STATES, FINAL = range(4), (0, 3)
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
ROLES = {"u": "user", "a": "assistant"}

#: The least (cost, audit) by state before and state after; None if there is no way.
Cell = tuple[tuple[tuple[int, str] | None, ...], ...]


def joined(left: Cell, right: Cell) -> Cell:
    """The cell of two adjacent spans."""
    rows = []
    for p in STATES:
        row = []
        for q in STATES:
            best = None
            for r in STATES:
                a, b = left[p][r], right[r][q]
                if a is not None and b is not None:
                    way = (a[0] + b[0], a[1] + b[1])
                    if best is None or way < best:
                        best = way
            row.append(best)
        rows.append(tuple(row))
    return tuple(rows)


def _cell(ways: list[tuple[int, int, int, str]]) -> Cell:
    best: dict[tuple[int, int], tuple[int, str]] = {}
    for p, q, cost, audit in ways:
        best[p, q] = min(best.get((p, q), (cost, audit)), (cost, audit))
    return tuple(tuple(best.get((p, q)) for q in STATES) for p in STATES)


@functools.lru_cache(1)
def insertions() -> Cell:
    """The insertion closure: no row, any insertions."""
    once = _cell([(p, p, 0, "") for p in STATES] + [(p, q, INSERT, "I") for initial, p, q in STEPS if initial in ROLES])
    cell = once
    while (longer := joined(cell, once)) != cell:
        cell = longer
    return cell


@functools.lru_cache(1024)
def row_cell(initial: str, fault: str) -> Cell:
    """A row between insertions."""
    ways = [(p, p, DELETE, "D") for p in STATES]
    if fault in ("", "truncated"):
        more = TRUNCATED if fault else 0
        ways += [(p, q, KEEP + more, "K") for step, p, q in STEPS if step == initial]
        ways += [(p, q, REROLE + more, "R") for step, p, q in STEPS if step in ROLES]
    return joined(joined(insertions(), _cell(ways)), insertions())


def span_cell(cells: list[Cell]) -> Cell:
    """The cell of adjacent spans, bottom-up by span length."""
    while len(cells) > 1:
        cells = [joined(*cells[k : k + 2]) if k + 1 < len(cells) else cells[k] for k in range(0, len(cells), 2)]
    return cells[0]


def damaged(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role and text of ``rows`` (nulls: one space) after damage by crc32(``conv_id:turn``) % 20: 0 drops a row, 1 empties its
    text, 2 takes ``.!?`` out of it, 3 repeats it, 4 makes its role user."""
    text = lambda name: F.coalesce(F.col(name).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat_ws(":", text("conv_id"), text("turn")).cast("binary")) % 20
    found = rows.select("conv_id", "turn", text("role").alias("role"), text("text").alias("text"), kind.alias("_kind")).filter("_kind != 0")
    said = F.when(F.col("_kind") == 1, "").when(F.col("_kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    copies = F.explode(F.sequence(F.lit(1), F.when(F.col("_kind") == 3, 2).otherwise(1)))
    return found.select("conv_id", "turn", F.when(F.col("_kind") == 4, "user").otherwise(F.col("role")).alias("role"), said.alias("text"), copies.alias("_copy")).drop("_copy")


def in_order(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, digest (of role and text) and ``at``, which rises in the order of the rows of a conversation; written."""
    space = lambda name: F.coalesce(F.col(name).cast("string"), F.lit(" ")).alias(name)
    found = rows.select("conv_id", "turn", space("role"), space("text"))
    keyed = found.withColumn("digest", F.unhex(F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")), 256)))
    # Equal rows are interchangeable; the last key lets partitions part them.
    order = [F.col("conv_id"), F.col("turn"), F.col("role"), F.substring("text", 1, 32), F.col("digest"), F.col("_tie")]
    placed = keyed.withColumn("_tie", F.monotonically_increasing_id()).repartitionByRange(*order).sortWithinPartitions(*order).drop("_tie")
    return written(placed.withColumn("at", F.monotonically_increasing_id()), "conversation-rows")


_SEGMENT = "at long, rows long, blank long, duplicate long, truncated long, illegal long, first string, last string, low long, high long, turns long, costs array<long>, audits array<string>"


def _segment(rows: list[dict]) -> dict:
    """What a run of rows of one conversation is to the rows around it; ``rows`` in order."""
    faults = [r["fault"] for r in rows]
    initials = [r["initial"] for r in rows]
    turns = [r["turn"] for r in rows if r["turn"] is not None]
    cell = span_cell([row_cell(i, f) for i, f in zip(initials, faults)])
    return {
        "at": rows[0]["at"], "rows": len(rows), "first": initials[0], "last": initials[-1], "illegal": sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])),
        "low": turns[0] if turns else None, "high": turns[-1] if turns else None, "turns": len(set(turns)), "cell": cell,
    } | {name: faults.count(name) for name in ("blank", "duplicate", "truncated")}


def _merged(segments: list[dict]) -> dict:
    """Adjacent segments as one."""
    out = segments[0] | {"cell": span_cell([s["cell"] for s in segments])}
    for s in segments[1:]:
        out["illegal"] += s["illegal"] + (out["last"] + s["first"] not in ("su", "ua", "au"))
        out["turns"] += s["turns"] - (s["low"] is not None and s["low"] == out["high"])
        out |= {"last": s["last"], "low": s["low"] if out["low"] is None else out["low"], "high": out["high"] if s["high"] is None else s["high"]}
        for name in ("rows", "blank", "duplicate", "truncated"):
            out[name] += s[name]
    return out


def _flat(segment: dict) -> dict:
    ways = [way for row in segment["cell"] for way in row]
    return {k: v for k, v in segment.items() if k != "cell"} | {"costs": [w and w[0] for w in ways], "audits": [w and w[1] for w in ways]}


def _deep(row: dict) -> dict:
    ways = [None if c is None else (c, a) for c, a in zip(row.pop("costs"), row.pop("audits"))]
    return row | {"cell": tuple(tuple(ways[4 * p : 4 * p + 4]) for p in STATES)}


def _mapped(df: DataFrame, make, schema: StructType) -> DataFrame:
    """``make`` yields rows (dicts) from each row of ``df`` (a dict)."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        from pyspark.sql.pandas.types import to_arrow_schema

        kinds = to_arrow_schema(schema)
        for batch in batches:
            found = [out for row in batch.to_pylist() for out in make(row)]
            yield pa.RecordBatch.from_arrays([pa.array([r[f.name] for r in found], f.type) for f in kinds], schema=kinds)

    return bounded_batches(df).mapInArrow(run, schema)


def reports(ordered: DataFrame, conversations: DataFrame) -> DataFrame:
    """Each of ``conversations(conv_id)``, with gaps, blank, duplicate, truncated, illegal, cost and audit from ``in_order`` rows."""
    conv = ordered.schema["conv_id"]
    # Where role and text of a conversation are first seen, if more than once.
    again = F.col("conv_id").alias("_conv"), F.col("digest").alias("_digest")
    repeats = ordered.groupBy(*again).agg(F.min("at").alias("_first"), F.count("*").alias("_n")).filter("_n > 1")
    same = F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("digest") == F.col("_digest"))
    end = F.substring(F.rtrim(F.col("text"), F.lit(BLANKS)), -1, 1)
    fault = F.when(end == "", "blank").when(F.col("at") > F.col("_first"), "duplicate").when(~end.isin(".", "!", "?"), "truncated").otherwise("")
    seen = ordered.join(repeats, same, "left").select("conv_id", "turn", "at", F.substring("role", 1, 1).alias("initial"), fault.alias("fault"))
    blocks = seen.groupBy(F.shiftright("at", BLOCK.bit_length() - 1).alias("block")).agg(F.array_sort(F.collect_list(F.struct("at", "conv_id", "turn", "initial", "fault"))).alias("rows"))
    segment = StructType([conv, *StructType.fromDDL(_SEGMENT)])

    def parse(row: dict) -> Iterator[dict]:
        run: list[dict] = []
        for r in [*row["rows"], None]:
            if run and (r is None or r["conv_id"] != run[0]["conv_id"]):
                yield {"conv_id": run[0]["conv_id"]} | _flat(_segment(run))
                run = []
            run.append(r)

    segments = _mapped(blocks.select("rows"), parse, segment)
    names = [f.name for f in segment if f.name != "conv_id"]
    every = conversations.select("conv_id").distinct().select("conv_id", F.lit(None).cast(StructType(segment.fields[1:])).alias("segment"))
    together = every.unionByName(segments.select("conv_id", F.struct(*names).alias("segment"))).groupBy("conv_id").agg(F.collect_list("segment").alias("segments"))
    report = StructType([conv, *StructType.fromDDL("gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string")])

    def summed(row: dict) -> Iterator[dict]:
        parts = sorted(row["segments"], key=lambda s: s["at"])
        if not parts:
            yield {"conv_id": row["conv_id"], "audit": ""} | dict.fromkeys(("gaps", "blank", "duplicate", "truncated", "illegal", "cost"), 0)
            return
        whole = _merged([_deep(s) for s in parts])
        cost, audit = min(whole["cell"][0][q] for q in FINAL if whole["cell"][0][q] is not None)
        gaps = 0 if whole["low"] is None else whole["high"] - whole["low"] + 1 - whole["turns"]
        yield {"conv_id": row["conv_id"], "gaps": gaps, "cost": cost, "audit": audit} | {name: whole[name] for name in ("blank", "duplicate", "truncated", "illegal")}

    return _mapped(together, summed, report)


def edited(audit: str, rows: Iterator[tuple[str, str]]) -> Iterator[tuple[str, str, str]]:
    """(edit, role, text) of the rows that an audit leaves of a conversation's (role, text), in order."""
    state = 0
    for edit in audit:
        role, text = ("", "") if edit == "I" else next(rows)
        if edit == "D":
            continue
        initial = role[:1] if edit == "K" else "a" if state == 2 else "u"
        state = next(q for step, p, q in STEPS if step == initial and p == state)
        yield edit, role if edit == "K" else ROLES[initial], text


def _streams(ordered: DataFrame, found: DataFrame) -> DataFrame:
    """Rows by conversation in order, each conversation's report (at -1) before them."""
    report = F.struct(*(c for c in found.columns if c != "conv_id"))
    heads = found.select("conv_id", F.lit(-1).cast("long").alias("at"), F.lit(None).cast("string").alias("role"), F.lit(None).cast("string").alias("text"), report.alias("report"))
    rows = ordered.select("conv_id", "at", "role", "text", F.lit(None).cast(heads.schema["report"].dataType).alias("report"))
    return bounded_batches(heads.unionByName(rows)).repartition("conv_id").sortWithinPartitions("conv_id", "at")


def _conversations(batches: Iterator) -> Iterator[tuple[object, dict, Iterator[tuple[str, str]]]]:
    """conv_id, report and (role, text) of each conversation; the rows of one must be read before the next is asked for."""
    each = (row for batch in batches for row in batch.to_pylist())
    head = next(each, None)
    while head is not None:
        following: list[dict] = []

        def rows():
            for row in each:
                if row["report"] is not None:
                    following.append(row)
                    return
                yield row["role"], row["text"]

        said = rows()
        yield head["conv_id"], head["report"], said
        for _ in said:
            pass
        head = following[0] if following else None


def repaired_turns(rows: DataFrame) -> DataFrame:
    """The rows of repaired conversations: conv_id, place (from 0), edit (I, K or R), role and text."""
    ordered = in_order(rows)
    found = reports(ordered, rows)
    schema = StructType([rows.schema["conv_id"], *StructType.fromDDL("place long, edit string, role string, text string")])

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        from pyspark.sql.pandas.types import to_arrow_schema

        kinds, out = to_arrow_schema(schema), []
        for conv, report, said in _conversations(batches):
            for place, (edit, role, text) in enumerate(edited(report["audit"], said)):
                out.append((conv, place, edit, role, text))
                if len(out) == BLOCK:
                    yield pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(zip(*out), kinds)], schema=kinds)
                    out = []
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(zip(*out), kinds)], schema=kinds)

    return _streams(ordered, found).mapInArrow(run, schema)


def repaired(rows: DataFrame, conversations: DataFrame | None = None) -> DataFrame:
    """One row for each conv_id of ``conversations`` (default: ``rows``): gaps (turns missing between the first and the last), blank, duplicate
    and truncated rows, illegal (adjacent roles other than su, ua, au), the cost and audit of the cheapest repair, and
    repaired_sha256 of its rows, each ``role:text``, joined by newlines. A conversation without rows: zeros, an empty audit, the hash of
    nothing. Repeated rows are duplicates."""
    ordered = in_order(rows)
    found = reports(ordered, rows if conversations is None else conversations)
    schema = StructType([*found.schema, StructField("repaired_sha256", found.schema["audit"].dataType)])

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        from pyspark.sql.pandas.types import to_arrow_schema

        kinds, out = to_arrow_schema(schema), []
        for conv, report, said in _conversations(batches):
            digest, mark = hashlib.sha256(), ""
            for _, role, text in edited(report["audit"], said):
                digest.update(f"{mark}{role}:{text}".encode())
                mark = "\n"
            out.append({"conv_id": conv, "repaired_sha256": digest.hexdigest()} | report)
            if len(out) == BLOCK:
                yield pa.RecordBatch.from_pylist(out, kinds)
                out = []
        if out:
            yield pa.RecordBatch.from_pylist(out, kinds)

    return _streams(ordered, found).mapInArrow(run, schema)
