r"""Repair of conversation structure by a run-length dynamic program.

Rows of a conversation stand in the order of their turns (nulls first; rows of
one turn by role, then by the text's SHA-256). A row's symbol is its role's
initial (``s``, ``u``, ``a`` or another) and its first fault: blank (no character
but white space), duplicate (role and text seen earlier), truncated (the last
character that isn't white space is none of ``.!?``) or none. Edits keep a row (0),
give it the role user or assistant (2), delete it (3; blank and duplicate rows must
go) or insert an empty user or assistant row (2); a truncated row that stays costs 1
more. The repaired roles' initials must match ``(s?(ua)+)?``. Of the cheapest
edits the ones whose initials (``D I K R``) are ASCII-least are taken.

The pattern is an automaton of four states, so a row is a 4 x 4 matrix of costs
and rows in sequence are their min-plus product. Method:

* Equal rows of a turn are counted, equal neighbouring symbols make a run, and a
  run of ``n`` is its symbol's matrix to the power ``n``, made of powers of two
  that a worker keeps. A block (at most ``BLOCK`` of a conversation's rows that
  lie together) is the product of its runs.
* From each conversation's last block backwards, the blocks' matrices give the
  cheapest cost of all that follows a block, for each state.
* With that, each block unrolls its choices from each state in which it may begin:
  at every row the least letter that keeps to the cheapest cost. Within a run the
  cost of the rest comes from the run's powers.
* From the first block forwards, the blocks' ends give the state in which each one
  begins, and so its audit.

The order over all rows is one range-partitioned sort, so a conversation that holds
a third of all rows is many blocks in many tasks; only one small row a block (a
matrix, four ends) passes through a conversation's own task, as a sorted stream.

Null roles and texts count as one space. A null conversation id is a conversation
of its own; repeated rows count one by one; extra columns are ignored; an empty
table gives no rows. A summary holds a conversation's audit as one string, as its
reader asks for it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from pressroom.llm.common import materialize, partitions, read

BLOCK_BITS = 14
#: Rows of a conversation in one block at most.
BLOCK = 1 << BLOCK_BITS
START, SYSTEM, USER, ASSISTANT = range(4)
ACCEPTED = (START, ASSISTANT)
INF = 1 << 40
KEEP, REROLE, DELETE, INSERT, CUT_SHORT = 0, 2, 3, 2, 1
ROLE = {USER: "user", ASSISTANT: "assistant"}
#: Where a row of each role leads: an assistant only after a user, a user anywhere else.
STEP = {"s": {START: SYSTEM}, "u": {START: USER, SYSTEM: USER, ASSISTANT: USER}, "a": {USER: ASSISTANT}}
BLANK, DUPLICATE, TRUNCATED, FINE = "b", "d", "t", "f"


def product(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Min-plus product."""
    return np.minimum((x[:, :, None] + y[None, :, :]).min(axis=1), INF)


def _insertions() -> np.ndarray:
    """Cost from state to state by insertions alone (two are enough to reach any)."""
    m = np.full((4, 4), INF, np.int64)
    np.fill_diagonal(m, 0)
    once = m.copy()
    for role in "ua":
        for p, q in STEP[role].items():
            once[p, q] = min(once[p, q], INSERT)
    return product(product(once, once), once)


def moves(symbol: str) -> list[tuple[str, int, int, int]]:
    """``letter, from, to, cost`` of what may be done with a row."""
    initial, fault = symbol
    out = [("D", p, p, DELETE) for p in range(4)]
    if fault in (BLANK, DUPLICATE):
        return out
    extra = CUT_SHORT if fault == TRUNCATED else 0
    out += [("K", p, q, KEEP + extra) for p, q in STEP.get(initial, {}).items()]
    return out + [("R", p, q, REROLE + extra) for role in "ua" for p, q in STEP[role].items()]


def inserts() -> list[tuple[str, int, int, int]]:
    return [("I", p, q, INSERT) for role in "ua" for p, q in STEP[role].items()]


@lru_cache(None)
def power_of_two(symbol: str, k: int) -> np.ndarray:
    """Matrix of ``2^k`` rows of a symbol, insertions before each."""
    if k:
        return product(half := power_of_two(symbol, k - 1), half)
    row = np.full((4, 4), INF, np.int64)
    for _, p, q, cost in moves(symbol):
        row[p, q] = min(row[p, q], cost)
    return product(_insertions(), row)


def run_matrix(symbol: str, n: int) -> np.ndarray:
    out = None
    for k in range(n.bit_length()):
        if n >> k & 1:
            out = power_of_two(symbol, k) if out is None else product(out, power_of_two(symbol, k))
    return out


@lru_cache(100_000)
def short_run(symbol: str, n: int) -> np.ndarray:
    return run_matrix(symbol, n)


def before(symbol: str, n: int, rest: np.ndarray) -> np.ndarray:
    """Cheapest cost from each state over ``n`` rows of a symbol and ``rest``."""
    return (short_run(symbol, n) + rest[None, :]).min(axis=1) if n else rest


def ending() -> np.ndarray:
    """Cheapest cost from each state after the last row."""
    return _insertions()[:, list(ACCEPTED)].min(axis=1)


def collapse(symbols: list[str], counts: list[int]) -> tuple[tuple[str, int], ...]:
    """Runs of equal neighbouring symbols."""
    runs: list[tuple[str, int]] = []
    for s, n in zip(symbols, counts):
        if runs and runs[-1][0] == s:
            runs[-1] = (s, runs[-1][1] + n)
        else:
            runs.append((s, n))
    return tuple(runs)


@lru_cache(20_000)
def block_matrix(runs: tuple[tuple[str, int], ...]) -> np.ndarray:
    out = None
    for s, n in runs:
        m = short_run(s, n)
        out = m if out is None else product(out, m)
    return out


@lru_cache(20_000)
def unroll(runs: tuple[tuple[str, int], ...], state: int, rest: tuple[int, ...], last: bool) -> tuple[str, int, str]:
    """The least cheapest edits of a block that begins in ``state``; the state at
    its end, and the state after each edit. ``rest`` is the cost of what follows;
    insertions before a later block's first row belong to that block."""
    after = [np.array(rest, np.int64)]
    for s, n in reversed(runs):
        after.append(before(s, n, after[-1]))
    after.reverse()  # after[i]: from the i-th run on
    letters, states, extra = [], [], inserts()
    for i, (s, n) in enumerate(runs):
        steps, costs = sorted(moves(s) + extra), None
        for left in range(n, 0, -1):
            now = before(s, left, after[i + 1]) if costs is None else costs
            costs = before(s, left - 1, after[i + 1])
            done = False
            while not done:  # insertions leave the row where it is
                for letter, p, q, cost in steps:
                    to = now if letter == "I" else costs
                    if p == state and cost + to[q] == now[p]:
                        break
                letters.append(letter)
                state, done = q, letter != "I"
                states.append(state)
    if last:
        while rest[state]:
            letter, _, state, _ = next(x for x in extra if x[1] == state and x[3] + rest[x[2]] == rest[state])
            letters.append(letter)
            states.append(state)
    return "".join(letters), state, "".join(map(str, states))


def _rows(rows: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """Equal rows of a turn counted, each with an id ``row``, its text's address
    and its own fault."""
    space = lambda c: F.coalesce(F.col(c), F.lit(" "))
    one = rows.select(F.col(conv).alias("conv"), F.col(turn).alias("turn"), space(role).alias("role"), space(text).alias("text"))
    said = F.rtrim(F.translate("text", "\t\n\x0b\x0c\r", "     "))
    fault = (F.when(said == "", BLANK).when(F.substring(said, -1, 1).isin(".", "!", "?"), FINE).otherwise(TRUNCATED))
    return (one.withColumn("hash", F.sha2("text", 256)).groupBy("conv", "turn", "role", "hash")
            .agg(F.count(F.lit(1)).alias("n"), F.first("text").alias("text"))
            .withColumn("fault", fault).withColumn("row", F.monotonically_increasing_id()))


def _symbols(rows: DataFrame) -> DataFrame:
    """Rows in order (``pos`` over all conversations) with their symbol; a row that
    stands first for its role and text, and the duplicates that follow it, are two."""
    first = materialize(rows.groupBy("conv", "role", "hash").agg(F.min(F.struct("turn")).alias("first")), "first-turns")
    same = (F.col("r.conv").eqNullSafe(F.col("f.conv")) & (F.col("r.role") == F.col("f.role"))
            & (F.col("r.hash") == F.col("f.hash")))
    light = (rows.drop("text").alias("r").join(first.alias("f"), same)
             .select("r.*", F.col("r.turn").eqNullSafe(F.col("f.first.turn")).alias("leads")))
    parts = F.array(F.struct(F.lit(0).alias("later"), F.when((F.col("fault") == BLANK), F.col("n")).otherwise(F.lit(1)).alias("n"), F.col("fault")),
                    F.struct(F.lit(1).alias("later"), F.when(F.col("fault") == BLANK, F.lit(0)).otherwise(
                        F.col("n") - F.when(F.col("leads"), 1).otherwise(0)).alias("n"), F.lit(DUPLICATE).alias("fault")))
    parts = F.when(F.col("leads") | (F.col("fault") == BLANK), parts).otherwise(F.slice(parts, 2, 1))
    initial = F.substring("role", 1, 1)
    symbol = F.concat(F.when(initial.isin("s", "u", "a"), initial).otherwise("-"), F.col("part.fault"))
    cut = (light.withColumn("part", F.explode(F.filter(parts, lambda x: x["n"] > 0)))
           .select("conv", "turn", "role", "hash", "row", F.col("part.later").alias("later"),
                   F.col("part.n").alias("n"), symbol.alias("symbol")))
    order = ["conv", "turn", "role", "hash", "later"]
    sorted_ = (cut.repartitionByRange(partitions(rows.sparkSession), *order).sortWithinPartitions(*order)
               .withColumn("pos", F.monotonically_increasing_id()))
    return materialize(sorted_.select("conv", "turn", "row", "symbol", "n", "pos"), "symbols")


def _stream(blocks: DataFrame, value: str, backwards: bool, step, schema: str) -> DataFrame:
    """Each conversation's blocks in order, as one sorted stream a task: ``step``
    gets (last row, this row's block and value, whether it is the first one of its
    conversation) and returns the state to carry and the rest of an output row."""
    order = F.desc("block") if backwards else F.col("block")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, carried = None, None
        for batch in batches:
            out = []
            for k, block, x in zip(batch["key"], batch["block"], batch[value]):
                carried, said = step(carried if k == key else None, x)
                key = k
                out.append((block, *said))
            yield pd.DataFrame(out, columns=["block", *(c.split()[0] for c in schema.split(", "))])

    return (blocks.select("key", "block", value).repartition(partitions(blocks.sparkSession), "key")
            .sortWithinPartitions("key", order).mapInPandas(run, f"block long, {schema}"))


def repair(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
           text: str = "text") -> tuple[DataFrame, DataFrame]:
    """``(summary, repaired)``. Summary: a row for each conversation with ``conv,
    gaps, blank, duplicate, truncated, illegal, cost, audit``. Repaired: the rows
    that stay, ``conv, key, block, nth`` (their order), ``role, text, edit``; ``key``
    is never null."""
    table = materialize(_rows(rows, conv, turn, role, text), "turns")
    symbols = _symbols(table)
    key = F.coalesce(F.concat(F.lit("="), F.col("conv").cast("string")), F.lit("null"))
    # a block's id is its first row's place, so ids rise along a conversation
    own = F.struct("pos", "row", "symbol", "n")
    blocks = (symbols.groupBy("conv", F.shiftright("pos", BLOCK_BITS).alias("part"))
              .agg(F.array_sort(F.collect_list(own)).alias("rows"))
              .select("conv", key.alias("key"), F.col("rows")[0]["pos"].alias("block"),
                      F.col("rows.row").alias("row"), F.col("rows.symbol").alias("symbol"), F.col("rows.n").alias("n")))

    def matrices(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        legal = {"su", "ua", "au"}
        for batch in batches:
            out = []
            for k, block, row, symbol, n in zip(*(batch[c] for c in ("key", "block", "row", "symbol", "n"))):
                symbol, n = list(symbol), [int(x) for x in n]
                role = [s[0] for s in symbol]
                illegal = sum(x - 1 for x in n) + sum(a + b not in legal for a, b in zip(role, role[1:]))
                matrix = block_matrix(collapse(symbol, n))
                out.append((k, block, row, symbol, n, [*matrix.ravel().tolist()], illegal, role[0] + role[-1]))
            yield pd.DataFrame(out, columns=["key", "block", "row", "symbol", "n", "matrix", "illegal", "ends"])

    blocks = blocks.select("key", "block", "row", "symbol", "n")
    blocks = materialize(blocks.mapInPandas(
        matrices, "key string, block long, row array<long>, symbol array<string>, n array<long>, "
                  "matrix array<long>, illegal long, ends string"), "blocks")

    def back(carried, matrix):
        rest = ending() if carried is None else carried
        now = (np.array(matrix, np.int64).reshape(4, 4) + rest[None, :]).min(axis=1)
        return now, (rest.tolist(), carried is None, int(now[START]))

    rest = _stream(blocks, "matrix", True, back, "rest array<long>, last boolean, total long")

    def choices(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for k, block, symbol, n, rest, last in zip(*(batch[c] for c in ("key", "block", "symbol", "n", "rest", "last"))):
                runs = collapse(list(symbol), [int(x) for x in n])
                found = [unroll(runs, p, tuple(int(x) for x in rest), last) for p in range(4)]
                out.append((k, block, *map(list, zip(*found))))
            yield pd.DataFrame(out, columns=["key", "block", "audits", "exits", "states"])

    plan = blocks.select("key", "block", "symbol", "n").join(rest, "block")
    unrolled = materialize(plan.select("key", "block", "symbol", "n", "rest", "last").mapInPandas(
        choices, "key string, block long, audits array<string>, exits array<int>, states array<string>"), "choices")

    def forth(carried, exits):
        state = START if carried is None else carried
        return int(exits[state]), (state,)

    entry = _stream(unrolled, "exits", False, forth, "entry int")
    chosen = materialize(unrolled.join(entry, "block").select(
        "key", "block", F.col("audits")[F.col("entry")].alias("audit"), F.col("states")[F.col("entry")].alias("states")), "audits")

    def seam(carried, ends):
        return ends[-1], (int(carried is not None and carried + ends[0] not in ("su", "ua", "au")),)

    seams = _stream(blocks, "ends", False, seam, "seam long")
    totals = blocks.select("key", "block", "illegal").join(seams, "block").join(rest.select("block", "total"), "block")
    # the total at a conversation's first block is its cost
    totals = totals.groupBy("key").agg(F.sum(F.col("illegal") + F.col("seam")).alias("illegal"),
                                       F.min_by("total", "block").alias("cost"))
    audits = chosen.groupBy("key").agg(F.array_sort(F.collect_list(F.struct("block", "audit"))).alias("x")).select(
        "key", F.array_join("x.audit", "").alias("audit"))
    fault = lambda f: F.coalesce(F.sum(F.when(F.substring("symbol", 2, 1) == f, F.col("n"))), F.lit(0))
    turns = symbols.groupBy("conv", "turn").agg(*[fault(f).alias(f) for f in (BLANK, DUPLICATE, TRUNCATED)])
    counts = turns.groupBy("conv").agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count("turn"), F.lit(0)).cast("long").alias("gaps"),
        F.sum(BLANK).alias("blank"), F.sum(DUPLICATE).alias("duplicate"), F.sum(TRUNCATED).alias("truncated"))
    summary = (counts.withColumn("key", key).join(totals, "key").join(audits, "key")
               .select("conv", "key", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit"))

    def kept(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for k, block, row, n, audit, states in zip(*(batch[c] for c in ("key", "block", "row", "n", "audit", "states"))):
                left = iter([r for r, times in zip(row, n) for r in [int(r)] * int(times)])
                for nth, (letter, state) in enumerate(zip(audit, states)):
                    r = -1 if letter == "I" else next(left)
                    if letter != "D":
                        out.append((k, block, nth, r, letter, None if letter == "K" else ROLE[int(state)]))
            yield pd.DataFrame(out, columns=["key", "block", "nth", "row", "edit", "given"])

    edits = blocks.select("block", "row", "n").join(chosen, "block").select(
        "key", "block", "row", "n", "audit", "states").mapInPandas(
        kept, "key string, block long, nth long, row long, edit string, given string")
    edits = materialize(edits, "edits")
    stay = edits.where("row >= 0").join(table.select("row", "role", "text"), "row").select(
        "key", "block", "nth", "edit", F.coalesce("given", "role").alias("role"), "text")
    added = edits.where("row < 0").select("key", "block", "nth", "edit", F.col("given").alias("role"), F.lit("").alias("text"))
    return summary, stay.unionByName(added)


def digests(repaired: DataFrame) -> DataFrame:
    """``key, sha256`` of each conversation's ``role:text`` lines. Texts pass by in
    order, none is held with the others."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key, digest = None, None
        for batch in batches:
            out = []
            for k, role, text in zip(batch["key"], batch["role"], batch["text"]):
                line = f"{role}:{text}".encode()
                if k != key:
                    if key is not None:
                        out.append((key, digest.hexdigest()))
                    key, digest = k, hashlib.sha256(line)
                else:
                    digest.update(b"\n" + line)
            yield pd.DataFrame(out, columns=["key", "sha256"])
        if key is not None:
            yield pd.DataFrame([(key, digest.hexdigest())], columns=["key", "sha256"])

    return (repaired.repartition(partitions(repaired.sparkSession), "key").sortWithinPartitions("key", "block", "nth")
            .select("key", "role", "text").mapInPandas(run, "key string, sha256 string"))


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows of ``conversations`` with the query's faults put in."""
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    rest = F.crc32(F.concat(space("conv_id"), F.lit(":"), space("turn")).cast("binary")) % 20
    text = (F.when(rest == 1, "").when(rest == 2, F.translate(space("text"), ".!?", "")).otherwise(space("text")))
    role = F.when(rest == 4, "user").otherwise(space("role"))
    return (conversations.select("conv_id", "turn", role.alias("role"), text.alias("text"),
                                 F.explode(F.sequence(F.lit(1), F.when(rest == 3, 2).otherwise(1))).alias("copy"),
                                 (rest == 0).alias("dropped")).where("not dropped").drop("copy", "dropped"))


def op13_chat_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = read(spark, sf_dir, "conversations")
    summary, repaired = repair(damaged(conversations))
    told = summary.join(digests(repaired), "key", "left")
    number = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c)
    every = conversations.select("conv_id").distinct()
    return every.join(told, every["conv_id"].eqNullSafe(told["conv"]), "left").select(
        "conv_id", *map(number, ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")),
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256"))


def _add(state: str, cost: str, letter: str) -> str:
    return f"lpad((left({state}, 9)::INT + {cost})::VARCHAR, 9, '0') || substr({state}, 10) || '{letter}'"


def _oracle() -> str:
    """The same rows in DuckDB SQL: a step for each row, and a state's best edits
    as one string (nine digits of cost, then letters), so the least string wins."""
    table = "CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END"
    live, extra = "fault NOT IN ('b', 'd')", "CASE WHEN fault = 't' THEN 1 ELSE 0 END"
    keep = lambda initial, state: f"CASE WHEN {live} AND initial = '{initial}' THEN {_add(state, extra, 'K')} END"
    give = lambda state: f"CASE WHEN {live} THEN {_add(state, '2 + ' + extra, 'R')} END"
    any_ = "least(q0, qs, qa)"
    insert = "least(nu, " + _add("least(n0, ns, na)", "2", "I") + ")"
    return f"""
WITH RECURSIVE crc AS (
  SELECT list(list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, j: {table}) ORDER BY i) AS tab FROM range(256) t(i)),
raw AS (SELECT conv_id, turn, coalesce(conv_id::VARCHAR, ' ') AS k, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
        coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS place FROM conversations),
hit AS (SELECT raw.*, xor(list_reduce(list_prepend(4294967295, list_transform(string_split(place, ''), lambda x: ascii(x)::BIGINT)),
        lambda c, b: xor(c >> 8, tab[(xor(c, b) & 255) + 1])), 4294967295) % 20 AS rest FROM raw, crc),
rows AS (SELECT k, turn, CASE WHEN rest = 4 THEN 'user' ELSE role END AS role,
         CASE rest WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
         FROM hit, LATERAL (SELECT unnest(range(CASE rest WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END))) WHERE rest > 0),
placed AS (SELECT *, left(role, 1) AS initial,
           row_number() OVER (PARTITION BY k ORDER BY turn NULLS FIRST, role, sha256(text)) AS i FROM rows),
sym AS (SELECT *, CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'b'
                       WHEN row_number() OVER (PARTITION BY k, role, text ORDER BY i) > 1 THEN 'd'
                       WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') THEN 't' ELSE 'f' END AS fault,
        initial || lead(initial) OVER (PARTITION BY k ORDER BY i) AS two FROM placed),
dp(k, i, q0, qs, qu, qa) AS (
  SELECT DISTINCT k, 0::BIGINT, '000000000', NULL::VARCHAR, '000000002I', '000000004II' FROM sym
  UNION ALL
  SELECT k, i, n0, ns, {insert}, least(na, {_add(insert, "2", "I")}) FROM (
    SELECT sym.k, sym.i, {_add('q0', '3', 'D')} AS n0, least({_add('qs', '3', 'D')}, {keep('s', 'q0')}) AS ns,
           least({_add('qu', '3', 'D')}, {keep('u', any_)}, {give(any_)}) AS nu,
           least({_add('qa', '3', 'D')}, {keep('a', 'qu')}, {give('qu')}) AS na
    FROM dp JOIN sym ON sym.k = dp.k AND sym.i = dp.i + 1)),
best AS (SELECT k, left(least(q0, qa), 9)::BIGINT AS cost, substr(least(q0, qa), 10) AS audit
         FROM dp JOIN (SELECT k, max(i) AS i FROM sym GROUP BY k) USING (k, i)),
letters AS (SELECT k, unnest(string_split(audit, '')) AS letter, unnest(range(1, length(audit) + 1)) AS p FROM best),
walk AS (SELECT *, sum((letter <> 'I')::INT) OVER w AS i, sum((letter <> 'D')::INT) OVER w AS o
         FROM letters WINDOW w AS (PARTITION BY k ORDER BY p)),
out AS (SELECT w.k, p, o, letter, CASE WHEN letter <> 'I' THEN s.role END AS role, CASE WHEN letter = 'I' THEN '' ELSE s.text END AS text,
        max((o = 1 AND letter = 'K' AND s.initial = 's')::INT) OVER (PARTITION BY w.k) AS lead_
        FROM walk w LEFT JOIN sym s ON s.k = w.k AND s.i = w.i WHERE letter <> 'D'),
said AS (SELECT k, string_agg(CASE WHEN letter = 'K' THEN role WHEN (o - lead_) % 2 = 1 THEN 'user' ELSE 'assistant' END
                              || ':' || text, chr(10) ORDER BY p) AS said FROM out GROUP BY k),
counts AS (SELECT k, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)::BIGINT AS gaps,
           count(*) FILTER (fault = 'b') AS blank, count(*) FILTER (fault = 'd') AS duplicate,
           count(*) FILTER (fault = 't') AS truncated,
           count(*) FILTER (i > 0 AND two NOT IN ('su', 'ua', 'au')) AS illegal FROM sym GROUP BY k),
every AS (SELECT DISTINCT conv_id, k FROM raw)
SELECT conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(cost, 0) AS cost,
       coalesce(audit, '') AS audit, sha256(coalesce(said, '')) AS repaired_sha256
FROM every LEFT JOIN counts USING (k) LEFT JOIN best USING (k) LEFT JOIN said USING (k)
"""


ORACLE = _oracle()
