"""Repair of conversations: cheapest edits that make the turns alternate, as an audit."""

from __future__ import annotations

import functools
import hashlib
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ebbtide.llm.staging import drop, keep, only, prepare_workers

# Grammar `(s?(ua)+)?`: what has been read so far, and the role that an edit may give next.
START, SYSTEM, USER, ASSISTANT = range(4)
EXPECTED = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
REMOVED = "x"  # a row that must go; others are s, u, a or o (another role), upper case if truncated
KEEP_COST, REROLE_COST, DELETE_COST, INSERT_COST, TRUNCATED_COST = 0, 2, 3, 2, 1
LEGAL = ("su", "ua", "au")
CHUNK_BITS = 12
SPACES = " \t\n\x0b\x0c\r"
ROLE_NAMES = {USER: "user", ASSISTANT: "assistant"}


def kept_as(state: int, row: str) -> int | None:
    """The state after a row that stays as it is, None if the grammar forbids it there."""
    role = row.lower()
    if role == "s" and state == START:
        return SYSTEM
    if role == "ua"[EXPECTED[state] == ASSISTANT]:
        return EXPECTED[state]
    return None


@dataclass(frozen=True)
class Node:
    """What a sequence of rows, read to its end, costs and calls for in each grammar state.

    letters and after hold, per state, the edits up to and with the node's first row and the state
    they lead to; following is the node of the rows after it. A node stands for every
    conversation that ends alike, its best audit suffix is its letters and those of the next.
    """

    cost: tuple[int, ...]
    letters: tuple[str, ...]
    after: tuple[int, ...]
    following: Node | None


def with_inserts(choices: list[tuple[int, str, int]]) -> tuple[tuple, tuple, tuple]:
    """Lets each state insert first what leads to a cheaper one; D < I < K < R breaks ties.

    The options of a state begin with different letters, so the first letter settles which of two
    audits of the same cost is less.
    """
    costs = [cost for cost, _, _ in choices]
    for _ in choices:
        costs = [min(cost, costs[EXPECTED[state]] + INSERT_COST)
                 for state, cost in enumerate(costs)]
    letters, after = [], []
    for state in range(len(choices)):
        before = ""
        while True:
            cost, letter, to = choices[state]
            inserted = costs[EXPECTED[state]] + INSERT_COST
            if (cost, letter) <= (inserted, "I"):
                break
            before, state = before + "I", EXPECTED[state]
        letters.append(before + letter)
        after.append(to)
    return tuple(costs), tuple(letters), tuple(after)


FORBIDDEN = 1 << 60
ACCEPTING = (0, FORBIDDEN, FORBIDDEN, 0)  # nothing at all, or an answer last


def end_node(costs: tuple[int, ...] = ACCEPTING, inserts: bool = True) -> Node:
    """The node of no rows; costs is what follows in another chunk, without inserts of its own."""
    listed = [(cost, "", state) for state, cost in enumerate(costs)]
    cost, letters, after = with_inserts(listed) if inserts else tuple(zip(*listed))
    return Node(cost, letters, after, None)


def prepend(row: str, node: Node) -> Node:
    """The node of a row and what follows it."""
    choices = []
    for state in range(4):
        options = [(DELETE_COST + node.cost[state], "D", state)]
        if row != REMOVED:
            flaw = TRUNCATED_COST if row.isupper() else 0
            stays = kept_as(state, row)
            if stays is not None:
                options.append((KEEP_COST + flaw + node.cost[stays], "K", stays))
            given = EXPECTED[state]
            options.append((REROLE_COST + flaw + node.cost[given], "R", given))
        choices.append(min(options))
    return Node(*with_inserts(choices), node)


def relative(costs: tuple[int, ...]) -> tuple[int, ...]:
    """Costs less the least: all that earlier rows need to know, and one of a few tuples."""
    least = min(costs)
    return tuple(c - least for c in costs)


class SuffixAutomaton:
    """Nodes of signatures that come sorted by their reversed rows.

    Signatures with a common end follow each other, so that end's nodes are still at hand: each
    is made once. Held are the nodes of one signature, whatever the number of signatures.
    """

    def __init__(self):
        self.rows, self.ending, self.nodes, self.made = "", None, [], 0

    def node(self, signature: str, ending: tuple[int, ...] | None) -> Node:
        backwards = signature[::-1]
        if not self.nodes or ending != self.ending:
            self.rows, self.ending = "", ending
            self.nodes = [end_node() if ending is None else end_node(ending, False)]
        same = 0
        for one, two in zip(self.rows, backwards):
            if one != two:
                break
            same += 1
        del self.nodes[same + 1:]
        for row in backwards[same:]:
            self.nodes.append(prepend(row, self.nodes[-1]))
            self.made += 1
        self.rows = backwards
        return self.nodes[-1]


def audit(node: Node, state: int) -> tuple[str, int]:
    """The cheapest edits from a state on, and the state they end in."""
    letters = []
    while node is not None:
        letters.append(node.letters[state])
        state, node = node.after[state], node.following
    return "".join(letters), state


def text_or_space(name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(" "))


def damaged(rows: DataFrame) -> DataFrame:
    """Rows with the faults that crc32 of `conv_id:turn` modulo 20 calls for: 0 drops a row,
    1 empties its text, 2 takes out `[.!?]`, 3 repeats it, 4 makes it the user's."""
    fault = F.crc32(F.concat(text_or_space("conv_id"), F.lit(":"), text_or_space("turn"))
                    .cast("binary")) % 20
    text = text_or_space("text")
    role = F.when(fault == 4, F.lit("user")).otherwise(text_or_space("role"))
    return rows.where(fault != 0).select(
        "conv_id", "turn", role.alias("role"),
        F.when(fault == 1, F.lit("")).when(fault == 2, F.regexp_replace(text, "[.!?]", ""))
        .otherwise(text).alias("text"),
        F.explode(F.when(fault == 3, F.array(F.lit(1), F.lit(1))).otherwise(F.array(F.lit(1))))
        .alias("copy")).drop("copy")


def identified(rows: DataFrame) -> DataFrame:
    """Adds name, a digest that rows with the same role and text share."""
    return rows.withColumn("name", F.unhex(F.sha2(F.concat(
        F.octet_length("role").cast("string"), F.lit(":"), "role", "text"), 256)))


def ordered_rows(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, name, role, fault, copies, place): equal rows of a turn as one, in order.

    role is the initial, or o for any other than s, u and a. place grows along conversation and
    turn over all partitions; a conversation is spread over as many as its rows need.
    """
    initial = F.substring("role", 1, 1)
    last = F.substring(F.rtrim(F.col("text"), F.lit(SPACES)), -1, 1)
    slim = keep(identified(rows).select(
        "conv_id", "turn", "name",
        F.when(initial.isin("s", "u", "a"), initial).otherwise("o").alias("role"),
        F.when(last == "", "blank").when(~last.isin(".", "!", "?"), "truncated").alias("fault"))
        .groupBy("conv_id", "turn", "name", "role", "fault").agg(
            F.count(F.lit(1)).alias("copies")))
    parts = int(slim.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = [F.col(c).asc_nulls_first() for c in ("conv_id", "turn", "name")]
    return keep(slim.repartitionByRange(parts, *order).sortWithinPartitions(*order)
                .withColumn("place", F.monotonically_increasing_id()))


def chunks(listed: DataFrame, bits: int) -> DataFrame:
    """(conv_id, chunk, signature, illegal, ...): runs of at most two to the bits listed rows.

    signature holds a letter per row. What a conversation needs to be counted over its chunks is
    kept beside: the first and last role, the turns and how many differ.
    """
    firsts = (listed.where(~F.col("fault").eqNullSafe("blank")).groupBy("conv_id", "name")
              .agg(F.min("place").alias("place")).select("place", F.lit(True).alias("first")))
    known = listed.join(firsts, "place", "left").select(
        "conv_id", F.shiftright("place", bits).alias("chunk"), "place", "turn", "role", "copies",
        F.col("fault").eqNullSafe("blank").alias("blank"),
        F.col("fault").eqNullSafe("truncated").alias("truncated"),
        F.coalesce("first", F.lit(False)).alias("first"))
    kept = F.when(F.col("truncated"), F.upper("role")).otherwise(F.col("role"))
    again = F.col("copies") - F.col("first").cast("long")
    row = F.struct("place", "role", "turn", F.concat(
        F.when(F.col("first"), kept).otherwise(""),
        F.expr(f"repeat('{REMOVED}', cast(copies - cast(first as int) as int))")).alias("signs"))
    count = F.sum(F.when(F.col("blank"), F.col("copies")).otherwise(0))
    made = known.groupBy("conv_id", "chunk").agg(
        F.sort_array(F.collect_list(row)).alias("rows"), count.alias("blank"),
        F.sum(F.when(~F.col("blank"), again).otherwise(0)).alias("duplicate"),
        F.count_if(F.col("first") & F.col("truncated")).alias("truncated"),
        F.sum(F.col("copies") - 1).alias("pairs"))
    roles = F.array_join("rows.role", "")
    length = F.length("roles")
    illegal = F.size(F.filter(
        F.sequence(F.lit(2), F.greatest(F.lit(2), length)),
        lambda at: (at <= length) & ~F.col("roles").substr(at - 1, F.lit(2)).isin(*LEGAL)))
    turns = F.filter("rows.turn", lambda t: t.isNotNull())
    return made.withColumn("roles", roles).select(
        "conv_id", "chunk", F.array_join("rows.signs", "").alias("signature"),
        "blank", "duplicate", "truncated", (F.col("pairs") + illegal).alias("illegal"),
        F.substring("roles", 1, 1).alias("first_role"), F.substring("roles", -1, 1).alias("last_role"),
        F.array_min(turns).alias("first_turn"), F.array_max(turns).alias("last_turn"),
        F.size(F.array_distinct(turns)).cast("long").alias("turns"))


@functools.lru_cache(maxsize=None)
def costs_before(row: str, costs: tuple[int, ...]) -> tuple[int, ...]:
    """Relative costs in front of a row; there are few of them, so few are ever worked out."""
    return relative(prepend(row, end_node(costs, False)).cost)


def with_endings(made: DataFrame) -> DataFrame:
    """Adds ending: relative costs of what follows a chunk, empty for a conversation's last."""
    schema = made.withColumn("ending", F.lit(""))

    def run(items):
        conversation, signature, costs = object(), "", None
        for batch in items:
            endings = []
            for one, rows in zip(batch.column("conv_id").to_pylist(),
                                 batch.column("signature").to_pylist()):
                if one == conversation:
                    costs = relative(end_node().cost) if costs is None else costs
                    for row in reversed(signature):
                        costs = costs_before(row, costs)
                else:
                    conversation, costs = one, None
                signature = rows
                endings.append("" if costs is None else ",".join(map(str, costs)))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(endings, pa.string())],
                names=[*batch.schema.names, "ending"])

    return (made.repartition("conv_id").sortWithinPartitions("conv_id", F.desc("chunk"))
            .mapInArrow(run, schema.schema))


PLANS = ("signature string, ending string, audits array<string>, exits array<int>, "
         "costs array<long>")


def plans_of(signatures: DataFrame) -> DataFrame:
    """The best audit, its cost and last state for each distinct signature and grammar state.

    Signatures are sorted from their end, so that a suffix automaton shares what they have in
    common, whichever conversations they come from.
    """
    def run(items):
        automaton = SuffixAutomaton()
        for batch in items:
            out = {"signature": [], "ending": [], "audits": [], "exits": [], "costs": []}
            for rows, ending in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                later = tuple(map(int, ending.split(","))) if ending else None
                node = automaton.node(rows, later)
                found = [audit(node, state) for state in range(4)]
                left = (0,) * 4 if later is None else later
                out["signature"].append(rows)
                out["ending"].append(ending)
                out["audits"].append([letters for letters, _ in found])
                out["exits"].append([state for _, state in found])
                out["costs"].append([node.cost[s] - left[found[s][1]] for s in range(4)])
            yield pa.RecordBatch.from_pydict(out, schema=pa.schema([
                ("signature", pa.string()), ("ending", pa.string()),
                ("audits", pa.list_(pa.string())), ("exits", pa.list_(pa.int32())),
                ("costs", pa.list_(pa.int64()))]))

    parts = int(signatures.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = ["ending", F.reverse("signature")]
    return (signatures.select("signature", "ending").distinct()
            .repartitionByRange(parts, *order).sortWithinPartitions(*order).mapInArrow(run, PLANS))


COUNTS = ("blank", "duplicate", "truncated", "illegal", "turns")


class Mending:
    """One conversation: its chunks in order, then its rows in order, are passed through it."""

    def __init__(self):
        self.letters, self.at, self.state = [], 0, START
        self.entry, self.cost, self.counts = START, 0, dict.fromkeys(COUNTS, 0)
        self.last_role = self.least = self.most = None

    def chunk(self, row: dict) -> None:
        self.letters.append(row["audits"][self.entry])
        self.cost += row["costs"][self.entry]
        self.entry = row["exits"][self.entry]
        for name in COUNTS:
            self.counts[name] += row[name]
        if self.last_role is not None and self.last_role + row["first_role"] not in LEGAL:
            self.counts["illegal"] += 1
        if row["first_turn"] is not None:
            if self.most == row["first_turn"]:
                self.counts["turns"] -= 1
            self.least = row["first_turn"] if self.least is None else self.least
            self.most = row["last_turn"]
        self.last_role = row["last_role"]

    @property
    def audit(self) -> str:
        if len(self.letters) != 1:
            self.letters = ["".join(self.letters)]
        return self.letters[0]

    def inserts(self):
        """The rows to be added here, as (edit, role, text)."""
        audit = self.audit
        while self.at < len(audit) and audit[self.at] == "I":
            self.at += 1
            self.state = EXPECTED[self.state]
            yield "I", ROLE_NAMES[self.state], ""

    def row(self, role: str, text: str):
        """What comes out for the next row: inserts before it and, unless deleted, itself."""
        yield from self.inserts()
        letter = self.audit[self.at]
        self.at += 1
        if letter == "R":
            self.state = EXPECTED[self.state]
            yield "R", ROLE_NAMES[self.state], text
        elif letter == "K":
            self.state = kept_as(self.state, role[:1])
            yield "K", role, text

    def gaps(self) -> int:
        if self.most is None:
            return 0
        return min(self.most - self.least + 1 - self.counts["turns"], (1 << 63) - 1)


def stream(rows: DataFrame, plans: DataFrame, ids: DataFrame) -> DataFrame:
    """Per conversation, in this order: itself, the plans of its chunks, its rows."""
    def lacking(df, kind, **columns):
        return df.select("conv_id", F.lit(kind).alias("kind"), *[
            columns.get(name, F.lit(None).cast(kind_of)).alias(name)
            for name, kind_of in fields])

    fields = [(f.name, f.dataType) for f in plans.schema if f.name != "conv_id"] + [
        ("turn", rows.schema["turn"].dataType), ("name", "binary"), ("role", "string"),
        ("text", "string")]
    own = {f.name: F.col(f.name) for f in plans.schema}
    texts = {name: F.col(name) for name in ("turn", "name", "role", "text")}
    order = ["conv_id", "kind", "chunk", "turn", "name"]
    return (lacking(ids, 0).unionAll(lacking(plans, 1, **own))
            .unionAll(lacking(identified(rows), 2, **texts))
            .repartition("conv_id").sortWithinPartitions(*order))


def conversations(items):
    """(conv_id, Mending, what the row gives) for every row of a stream, None where one ends."""
    mending, conversation = None, None
    for batch in items:
        names = batch.schema.names
        kinds, ids = batch.column("kind").to_pylist(), batch.column("conv_id").to_pylist()
        roles, texts = batch.column("role"), batch.column("text")
        for at, kind in enumerate(kinds):
            if kind == 0:
                if mending is not None:
                    yield conversation, mending, mending.inserts()
                    yield conversation, mending, None
                mending, conversation = Mending(), ids[at]
            elif kind == 1:
                mending.chunk({name: batch.column(name)[at].as_py() for name in names})
            else:
                yield conversation, mending, mending.row(roles[at].as_py(), texts[at].as_py())
    if mending is not None:
        yield conversation, mending, mending.inserts()
        yield conversation, mending, None


def chunk_plans(rows: DataFrame, bits: int = CHUNK_BITS) -> DataFrame:
    """Per conversation and chunk: counts, and audits, costs and exits by state of entry."""
    listed = ordered_rows(rows)
    ended = keep(with_endings(chunks(listed, bits)))
    drop(listed)
    plans = keep(plans_of(ended))
    return ended.join(plans, ["signature", "ending"]).drop("signature", "ending")


REPORT = ("conv_id {}, gaps long, blank long, duplicate long, truncated long, illegal long, "
          "cost long, audit string, repaired_sha256 string")


def normal(rows: DataFrame) -> DataFrame:
    """The four columns; a NULL role or text is one space."""
    return rows.select("conv_id", "turn", text_or_space("role").alias("role"),
                       text_or_space("text").alias("text"))


def repair_report(rows: DataFrame, ids: DataFrame | None = None,
                  bits: int = CHUNK_BITS) -> DataFrame:
    """Per conversation: faults found, cost and audit of the cheapest repair, and its digest.

    rows have conv_id, turn, role and text; ids names conversations to be reported besides. Rows
    are taken by turn, NULL first, then by a digest of role and text. A NULL conv_id is a
    conversation too. Long conversations are planned in chunks of two to the bits distinct rows,
    by many tasks; only the digest, which is one stream of bytes, reads one conversation in one
    task, batch after batch.
    """
    prepare_workers(rows.sparkSession)
    rows = normal(rows)
    named = rows.select("conv_id")
    named = (named if ids is None else named.unionAll(ids.select("conv_id"))).distinct()

    def run(items):
        columns = [[] for _ in range(9)]
        sha, first = hashlib.sha256(), True
        for conversation, mending, made in conversations(items):
            if made is not None:
                for _, role, text in made:
                    sha.update(("" if first else "\n").encode() + f"{role}:{text}".encode())
                    first = False
                continue
            counts = mending.counts
            values = (conversation, mending.gaps(), counts["blank"], counts["duplicate"],
                      counts["truncated"], counts["illegal"], mending.cost, mending.audit,
                      sha.hexdigest())
            for column, value in zip(columns, values):
                column.append(value)
            sha, first = hashlib.sha256(), True
            if len(columns[0]) >= 1024:
                yield table(columns)
                columns = [[] for _ in range(9)]
        yield table(columns)

    def table(columns):
        kinds = [pa.int64()] * 7 + [pa.string()] * 2
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds)],
            names=["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost",
                   "audit", "repaired_sha256"])

    return stream(rows, chunk_plans(rows, bits), named).mapInArrow(run, REPORT.format("long"))


def repaired_rows(rows: DataFrame, bits: int = CHUNK_BITS) -> DataFrame:
    """(conv_id, position, edit, role, text): the rows of the repaired conversations.

    position counts from 1 inside a conversation; edit is K, R or I.
    """
    prepare_workers(rows.sparkSession)
    rows = normal(rows)

    def run(items):
        position, out = 0, []
        for conversation, _, made in conversations(items):
            if made is None:
                position = 0
                continue
            for edit, role, text in made:
                position += 1
                out.append((conversation, position, edit, role, text))
            if len(out) >= 1024:
                yield table(out)
                out = []
        yield table(out)

    def table(out):
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string()]
        columns = zip(*out) if out else [()] * 5
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds)],
            names=["conv_id", "position", "edit", "role", "text"])

    return stream(rows, chunk_plans(rows, bits), rows.select("conv_id").distinct()).mapInArrow(
        run, "conv_id long, position long, edit string, role string, text string")


def conversation_repairs(conversations: DataFrame) -> DataFrame:
    """Damages every conversation by the rule of ``damaged`` and reports its cheapest repair.

    Conversations that lose all rows are reported with zeros, an empty audit and the digest of
    nothing. Extra columns are ignored, an empty table gives an empty result.
    """
    rows = only(conversations, conv_id="conv_id", turn="turn", role="role", text="text").select(
        F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text")
    return repair_report(damaged(rows), rows)
