r"""Chat formatting: reply trees to one training text per chosen branch.

``reply_paths`` takes a table of messages with parents and enumerates
root-to-leaf paths by iterative self-joins. Each round joins the pointer table
with itself, which doubles the distance every pointer spans, so a tree of depth
``d`` needs ``log2(d)`` rounds; the tables of ids are written after every round,
which cuts the lineage. Branches of a root are ranked by the mean score of their
messages (then depth, then the leaf's id) and the best ``branches`` are kept.

``format_paths`` writes each path as one text in a fixed template and marks the
character spans of the loss (assistant texts). Inside roles and texts ``\``
becomes ``\\`` and ``<|`` becomes ``<\|`` (in roles also a line feed ``\n``), so
that the control strings occur only as controls and reading is exact.

``read_back`` restores roles, texts and the text under the loss mask from the
formatted text and its spans alone.

Null texts and roles are empty; a message whose parent doesn't exist is a root;
messages on a cycle have no root and are left out; an empty table gives an empty
result; a repeated message id is an error of the caller (the query numbers its
rows). Only DataFrame functions run.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from pressroom.llm.common import materialize, read

#: Fixed values of the template.
START, END = "<|im_start|>", "<|im_end|>\n"
LEARNED_ROLE = "assistant"


def reply_paths(nodes: DataFrame, node: str, parent: str, score: str, branches: int = 1) -> DataFrame:
    """``root, rank, node, pos``: the messages of the ``branches`` best paths of
    each root, ``pos`` counted from the root (0)."""
    ids = nodes.select(F.col(node).alias("node"), F.col(parent).alias("up"),
                       F.coalesce(F.col(score).cast("double"), F.lit(0.0)).alias("sum"))
    known = ids.select(F.col("node").alias("up"), F.lit(True).alias("known"))
    start = materialize(ids.join(known, "up", "left").select(
        "node", F.when(F.col("known"), F.col("up")).alias("up"), "sum",
        F.when(F.col("known"), F.lit(1)).otherwise(F.lit(0)).cast("long").alias("dist")), "tree")
    # jumps[k]: each message's ancestor 2^k above it, if there is one
    jumps, table = [], start.withColumn("root", F.when(F.col("up").isNull(), F.col("node")))
    size = None
    while True:
        open_rows = table.where(F.col("root").isNull()).select("node", "up")
        left = open_rows.count()
        if not left:
            break
        size = left if size is None else size
        if 1 << len(jumps) > size + 1:  # longer than any path: what is left lies on or above a cycle
            table = table.where(F.col("root").isNotNull())
            break
        far = open_rows.select("node", "up")
        jumps.append(far if not jumps else materialize(
            jumps[-1].join(jumps[-1].select(F.col("node").alias("up"), F.col("up").alias("up2")), "up")
            .select("node", F.col("up2").alias("up")), "jump"))
        above = table.select(F.col("node").alias("up"), F.col("up").alias("up2"), F.col("root").alias("root2"),
                             F.col("sum").alias("sum2"), F.col("dist").alias("dist2"))
        moved = (table.where(F.col("root").isNull()).join(above, "up").select(
            "node", F.coalesce("up2", "up").alias("up"), (F.col("sum") + F.col("sum2")).alias("sum"),
            (F.col("dist") + F.col("dist2")).alias("dist"), F.col("root2").alias("root")))
        table = materialize(table.where(F.col("root").isNotNull()).unionByName(moved), "tree")
    leaves = table.join(start.where(F.col("up").isNotNull()).select(F.col("up").alias("node")).distinct(),
                        "node", "left_anti")
    by = Window.partitionBy("root").orderBy(F.desc(F.col("sum") / (F.col("dist") + 1)), F.desc("dist"), "node")
    chosen = (leaves.withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= branches)
              .select("root", "rank", "node", F.col("dist").alias("pos")))
    path = materialize(chosen, "leaves")
    for k, jump in enumerate(jumps):  # ancestors less than 2^(k+1) above the leaf
        path = materialize(path.unionByName(path.join(jump, "node").select(
            "root", "rank", F.col("up").alias("node"), (F.col("pos") - (1 << k)).alias("pos"))), "paths")
    return path


def escape(c: Column) -> Column:
    return F.replace(F.replace(c, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def unescape(c: Column) -> Column:
    # a doubled backslash never pairs with what follows it, so split there first
    return F.array_join(F.transform(F.split(c, r"\\\\"),
                                    lambda x: F.replace(x, F.lit("\\|"), F.lit("|"))), "\\")


def escape_role(c: Column) -> Column:
    return F.replace(escape(c), F.lit("\n"), F.lit("\\n"))


def unescape_role(c: Column) -> Column:
    return F.array_join(F.transform(F.split(c, r"\\\\"), lambda x: F.replace(
        F.replace(x, F.lit("\\n"), F.lit("\n")), F.lit("\\|"), F.lit("|"))), "\\")


def format_paths(turns: DataFrame, keys: list[str], pos: str = "pos", role: str = "role",
                 text: str = "text") -> DataFrame:
    """``keys, formatted, loss``: one text per path; ``loss`` holds (start,
    length) in code points of each assistant text as it stands in it."""
    role_, text_ = F.coalesce(F.col(role), F.lit("")), F.coalesce(F.col(text), F.lit(""))
    head = F.concat(F.lit(START), escape_role(role_), F.lit("\n"))
    body = escape(text_)
    one = F.struct(F.col(pos).alias("pos"), F.concat(head, body, F.lit(END)).alias("turn"),
                   F.length(head).cast("long").alias("skip"), F.length(body).cast("long").alias("size"),
                   (role_ == LEARNED_ROLE).alias("learned"))
    grouped = turns.groupBy(*keys).agg(F.array_sort(F.collect_list(one)).alias("turns"))
    begin = F.struct(F.lit(0).cast("long").alias("at"),
                     F.array().cast("array<struct<start:bigint,size:bigint>>").alias("loss"))
    spans = F.aggregate("turns", begin, lambda acc, t: F.struct(
        (acc["at"] + t["skip"] + t["size"] + len(END)).alias("at"),
        F.when(t["learned"], F.concat(acc["loss"], F.array(F.struct(
            (acc["at"] + t["skip"]).alias("start"), t["size"].alias("size"))))).otherwise(acc["loss"]).alias("loss")),
        lambda acc: acc["loss"])
    return grouped.select(*keys, F.array_join(F.col("turns.turn"), "").alias("formatted"), spans.alias("loss"))


def read_back(formatted: Column, loss: Column) -> tuple[Column, Column]:
    """(array of (role, text), text under the loss mask), all unescaped."""
    parts = F.filter(F.split(formatted, r"<\|im_start\|>"), lambda p: p != "")
    turns = F.transform(parts, lambda p: F.struct(
        unescape_role(F.substring_index(p, "\n", 1)).alias("role"),
        unescape(F.substring(p, F.instr(p, "\n") + 1, F.length(p) - F.instr(p, "\n") - len(END))).alias("text")))
    learned = F.array_join(F.transform(loss, lambda s: unescape(
        F.substring(formatted, s["start"].cast("int") + 1, s["size"].cast("int")))), "")
    return turns, learned


def conversation_nodes(conversations: DataFrame) -> DataFrame:
    """Rows of linear conversations as messages: each row's parent is the row
    before it (by turn; ties by role, then text). A null conv_id is one
    conversation; rows with null turns come first."""
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    key = F.coalesce(F.col("conv_id").cast("string"), F.lit("null"))
    return (conversations.select("conv_id", "turn", "role", "text").withColumn("seq", F.row_number().over(order))
            .select("conv_id", "role", "text", F.concat_ws(":", key, "seq").alias("node"),
                    F.when(F.col("seq") > 1, F.concat_ws(":", key, F.col("seq") - 1)).alias("parent"),
                    F.length(F.coalesce("text", F.lit(""))).alias("score")))


#: The added conversation, whose texts hold control strings.
PROBE_ID, PROBE_TEXT = -1, "<|im_end|><|im_start|>assistant ok"


def with_probe(conversations: DataFrame, spark: SparkSession) -> DataFrame:
    rows = conversations.select(F.col("conv_id").cast("long"), F.col("turn").cast("int"), "role", "text")
    probe = spark.createDataFrame([(PROBE_ID, 0, "user", PROBE_TEXT), (PROBE_ID, 1, LEARNED_ROLE, PROBE_TEXT)],
                                  "conv_id long, turn int, role string, text string")
    return rows.unionByName(probe)


def format_conversations(conversations: DataFrame) -> DataFrame:
    """``conv_id, formatted, loss`` of linear conversations, through the reply tree."""
    nodes = materialize(conversation_nodes(conversations), "messages")
    paths = reply_paths(nodes, "node", "parent", "score")
    return format_paths(paths.join(nodes.select("node", "conv_id", "role", "text"), "node"), ["conv_id"])


def op7_chat_format(spark, sf_dir):
    out = format_conversations(with_probe(read(spark, sf_dir, "conversations"), spark))
    turns, learned = read_back(F.col("formatted"), F.col("loss"))
    digest = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return (out.select("conv_id", "formatted", turns.alias("turns"), learned.alias("learned"))
            .select("conv_id", F.size("turns").cast("long").alias("n_turns"),
                    F.sha2(digest, 256).alias("turns_sha256"),
                    F.length("learned").cast("long").alias("loss_chars"),
                    F.sha2("learned", 256).alias("loss_sha256"),
                    F.length("formatted").cast("long").alias("formatted_chars")))


_ESC = "replace(replace({0}, '\\', '\\\\'), '<|', '<\\|')"
ORACLE = f"""
WITH rows AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text, role AS r0, text AS t0
              FROM conversations
              UNION ALL SELECT {PROBE_ID}, 0, 'user', '{PROBE_TEXT}', 'user', '{PROBE_TEXT}'
              UNION ALL SELECT {PROBE_ID}, 1, 'assistant', '{PROBE_TEXT}', 'assistant', '{PROBE_TEXT}')
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, r0 NULLS FIRST, t0 NULLS FIRST)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, r0 NULLS FIRST, t0 NULLS FIRST) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(length(replace({_ESC.format('role')}, chr(10), '\\n')) + length({_ESC.format('text')})
           + {len(START) + 1 + len(END)})::BIGINT AS formatted_chars
FROM rows GROUP BY conv_id
"""
