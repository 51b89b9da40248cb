"""Operator 11: the cheapest repair of a conversation's turns, and the least of the cheapest.

A conversation is read by turn; blank rows and repeats of an earlier row must
go.  What is left has to be an optional system row, then user and assistant
rows in turn, which edits bring about: keep, change the role, delete, insert.

* Costs: a row is a 4 x 4 matrix of least costs between the states of the
  grammar; costs to the end of all rows come from products over stretches of
  1, 2, 4, ... rows (min-plus).
* Ranks: arcs that lie on cheapest paths are kept, and their nodes are ranked
  by the least audit (string of edits) of 1, 2, 4, ... letters that leads on
  from them: the rank of twice the length is that of a node's rank and the rank
  of the node its pointer leads to; pointers double with it.  Arcs of one node
  have different letters, so a least string leads to one node.  The final ranks
  select the arc of each node, and doubled pointers mark the path.

Rows are sorted once over the cluster; blocks of that order, of a bounded
number of rows whatever conversations they hold, are solved in tasks by array
operations.  A conversation over several blocks passes costs back and states
on between its blocks by one small row per block.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WORD_CLASS, ship_package, small_batches, stored

# What edits cost, and what an unended row costs that stays.
RELABEL, DELETE, INSERT, UNENDED = 1, 2, 5, 5
USER, ASSISTANT = "user", "assistant"
#: Rows a block holds; a third of all rows in one conversation is many blocks.
BLOCK_ROWS = 1 << 15

# States: nothing yet, after a system row, after a user row, after an assistant row.
START, SYSTEM, ASKED, ANSWERED = range(4)
_FAR = np.int64(1) << 40
#: Where a kept row, a user and an assistant row lead from each state; -1: nowhere.
_NEXT = {"s": (SYSTEM, -1, -1, -1), "u": (ASKED, ASKED, -1, ASKED), "a": (-1, -1, ANSWERED, -1)}
#: The role that is due in each state, and the state after it.
_DUE = ("u", "u", "a", "u")
_DUE_STATE = np.array([ASKED, ASKED, ANSWERED, ASKED])
#: Letters in ASCII order; their numbers are ranks of one letter, 0 is the end.
LETTERS = " DIKR"
_D, _I, _K, _R = 1, 2, 3, 4

# A row's class: initial (s, u, a, other) and whether it is unended; the last class must go.
_INITIALS = "sua"
_GONE = 8


def _class_costs() -> tuple[np.ndarray, np.ndarray]:
    """(keep, relabel) cost per class, infinite where the edit is not allowed."""
    keep, relabel = np.full(9, _FAR), np.full(9, _FAR)
    for initial in range(4):
        for unended in (0, 1):
            relabel[2 * initial + unended] = RELABEL + UNENDED * unended
            if initial < 3:
                keep[2 * initial + unended] = UNENDED * unended
    return keep, relabel


_KEEP, _RELABEL = _class_costs()
_KEEP_STATE = np.array([_NEXT[_INITIALS[c // 2]] if c // 2 < 3 else (-1,) * 4 for c in range(9)])
#: Least cost of insertions alone, from state to state.
_INSERTED = np.array([[0, _FAR, INSERT, 2 * INSERT], [_FAR, 0, INSERT, 2 * INSERT],
                      [_FAR, _FAR, 0, INSERT], [_FAR, _FAR, INSERT, 0]])
#: Cost to the end behind the last row: an open question is answered, a lone system row needs both.
AT_END = np.array([0, 2 * INSERT, INSERT, 0])


def _times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.minimum((a[..., :, :, None] + b[..., None, :, :]).min(axis=-2), _FAR)


def _row_matrices() -> np.ndarray:
    out = np.full((9, 4, 4), _FAR)
    for c in range(9):
        for s in range(4):
            out[c, s, s] = DELETE
            to = _DUE_STATE[s]
            out[c, s, to] = min(out[c, s, to], _RELABEL[c])
            if _KEEP_STATE[c, s] >= 0:
                out[c, s, _KEEP_STATE[c, s]] = min(out[c, s, _KEEP_STATE[c, s]], _KEEP[c])
    return _times(_INSERTED[None], out)


_MATRICES = _row_matrices()


def _suffix_products(classes: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """For each row the product of the matrices from it to its stretch's end (``ends``: one past, per row)."""
    out, n = _MATRICES[classes], len(classes)
    reach, longest = 1, int((ends - np.arange(n)).max()) if n else 0
    while reach < longest:
        with_next = np.flatnonzero(np.arange(n) + reach < ends)
        out[with_next] = _times(out[with_next], out[with_next + reach])
        reach *= 2
    return out


def solve(classes: np.ndarray, lengths: np.ndarray, entries: np.ndarray, ends: np.ndarray,
          last: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The least cheapest path of every stretch of rows.

    ``lengths``: rows per stretch; ``entries``: the state each begins in;
    ``ends``: cost to the end from each state behind it; ``last``: whether the
    conversation ends there.  Returns, per edit in order, (stretch, row within
    it, letter, state before), and the state each stretch ends in.
    """
    n, m = int(lengths.sum()), len(lengths)
    begins = np.cumsum(lengths) - lengths
    stretch = np.repeat(np.arange(m), lengths)
    products = _suffix_products(classes, (begins + lengths)[stretch])
    # Layers: a layer before each row and one behind the last of a stretch; nodes are (layer, state).
    layer_of_row = np.arange(n) + stretch
    last_layer = begins + lengths + np.arange(m)
    cost = np.empty((n + m, 4), np.int64)
    cost[layer_of_row] = (products + ends[stretch][:, None, :]).min(axis=-1)
    cost[last_layer] = ends
    states = np.arange(4)

    heads = np.full((4, n + m, 4), -1, np.int64)  # by letter: the node an arc of a cheapest path leads to

    def arc(letter: int, layers: np.ndarray, to_layers: np.ndarray, to_state: np.ndarray, price: np.ndarray) -> None:
        there = cost[to_layers[:, None], np.maximum(to_state, 0)] + price
        good = (to_state >= 0) & (there == cost[layers])
        heads[letter - 1, layers] = np.where(good, 4 * to_layers[:, None] + to_state, -1)

    row_layers, follow = layer_of_row, layer_of_row + 1
    wide = np.broadcast_to(states, (n, 4))
    arc(_D, row_layers, follow, wide, np.full((n, 4), DELETE))
    arc(_K, row_layers, follow, _KEEP_STATE[classes], np.broadcast_to(_KEEP[classes][:, None], (n, 4)))
    arc(_R, row_layers, follow, np.broadcast_to(_DUE_STATE, (n, 4)),
        np.broadcast_to(_RELABEL[classes][:, None], (n, 4)))
    # Behind the last row of a stretch that goes on elsewhere, insertions belong to the next stretch.
    inserts = np.sort(np.concatenate([row_layers, last_layer[last]]))
    arc(_I, inserts, inserts, np.broadcast_to(_DUE_STATE, (len(inserts), 4)), np.full((len(inserts), 4), INSERT))
    heads = heads.reshape(4, -1)

    nodes = np.arange(4 * (n + m))
    rank = np.zeros(len(nodes), np.int64)
    pointer = nodes.copy()
    for letter in (_R, _K, _I, _D):  # the least letter is set last
        here = heads[letter - 1] >= 0
        rank[here], pointer[here] = letter, heads[letter - 1][here]
    # The longest audit: every row is edited once, with at most two insertions before it and behind the last.
    rounds = int(3 * (int(lengths.max()) if m else 0) + 3).bit_length()
    for _ in range(rounds):
        key = rank * (rank.max() + 1) + rank[pointer]
        rank = np.unique(key, return_inverse=True)[1].reshape(-1)
        pointer = pointer[pointer]
    best = np.full(len(nodes), -1, np.int64)
    chosen, least = np.zeros(len(nodes), np.int64), np.full(len(nodes), np.iinfo(np.int64).max)
    for letter in (_D, _I, _K, _R):
        head = heads[letter - 1]
        key = np.where(head >= 0, letter * (rank.max() + 1) + rank[head], np.iinfo(np.int64).max)
        better = key < least
        least[better], chosen[better], best[better] = key[better], letter, head[better]

    # The nodes of the chosen paths: those that pointers of 1, 2, 4, ... steps reach from the entries.
    step = np.where(best >= 0, best, nodes)
    steps = [step]
    for _ in range(rounds):
        steps.append(steps[-1][steps[-1]])
    on_path = np.zeros(len(nodes), bool)
    on_path[4 * (begins + np.arange(m)) + entries] = True
    for jump in reversed(steps):
        on_path[jump[np.flatnonzero(on_path)]] = True
    last_jump = steps[-1][4 * (begins + np.arange(m)) + entries]
    path = np.flatnonzero(on_path & (best >= 0))
    # Within a layer insertions come first; they go from a state to its due one, the other arcs leave the layer.
    layer, state, letter = path // 4, path % 4, chosen[path]
    entered = np.zeros(len(nodes), np.int64)  # insertions before a node within its layer
    for _ in range(2):
        ins = path[letter == _I]
        entered[best[ins]] = entered[ins] + 1
    order = np.lexsort((entered[path], layer))
    layer, state, letter = layer[order], state[order], letter[order]
    owner = np.searchsorted(last_layer, layer)
    return owner, layer - (begins + np.arange(m))[owner], letter, state, last_jump % 4


def _classes(table: pa.Table) -> np.ndarray:
    initial = table.column("initial").to_numpy()
    gone = table.column("must_go").to_numpy()
    return np.where(gone, _GONE, 2 * initial + table.column("unended").to_numpy()).astype(np.int64)


def _matrix_of(table: pa.Table) -> pa.Table:
    """The product over the rows of one conversation in one block."""
    table = table.sort_by("at")
    n = table.num_rows
    product = _suffix_products(_classes(table), np.full(n, n))[0].reshape(-1)
    return pa.table({"conv": table.column("conv").slice(0, 1), "block": table.column("block").slice(0, 1),
                     "matrix": pa.array([product.tolist()], pa.list_(pa.int64()))})


def _costs_back(table: pa.Table) -> pa.Table:
    """Cost to the end behind each block of one conversation, from its last block to its first."""
    table = table.sort_by("block")
    matrices = np.array(table.column("matrix").to_pylist(), np.int64).reshape(-1, 4, 4)
    costs = np.empty((len(matrices), 4), np.int64)
    behind = AT_END
    for i in range(len(matrices) - 1, -1, -1):
        costs[i] = behind
        behind = (matrices[i] + behind[None, :]).min(axis=1)
    return pa.table({"conv": table.column("conv"), "block": table.column("block"),
                     "ends": pa.array(costs.tolist(), pa.list_(pa.int64())),
                     "last": pa.array([False] * (len(matrices) - 1) + [True])})


def _exits_of(table: pa.Table) -> pa.Table:
    """The state that one conversation's rows of a block lead to from each state."""
    table = table.sort_by("at")
    classes, n = _classes(table), table.num_rows
    ends = np.array([table.column("ends")[0].as_py()])
    last = np.array([table.column("last")[0].as_py()])
    out = [int(solve(classes, np.array([n]), np.array([s]), ends, last)[4][0]) for s in range(4)]
    return pa.table({"conv": table.column("conv").slice(0, 1), "block": table.column("block").slice(0, 1),
                     "exits": pa.array([out], pa.list_(pa.int64()))})


def _states_on(table: pa.Table) -> pa.Table:
    """The state in which each block of one conversation begins."""
    table = table.sort_by("block")
    states = [START]
    for exits in table.column("exits").to_pylist()[:-1]:
        states.append(exits[states[-1]])
    return pa.table({"conv": table.column("conv"), "block": table.column("block"),
                     "entry": pa.array(states, pa.int64())})


def _edits_of_block(table: pa.Table) -> pa.Table:
    """The edits of all rows of one block."""
    table = table.sort_by("at")
    n = table.num_rows
    conv = table.column("conv").combine_chunks()
    codes = conv.dictionary_encode().indices.fill_null(-1).to_numpy(zero_copy_only=False)
    first = np.flatnonzero(np.concatenate([[True], codes[1:] != codes[:-1]]))
    lengths = np.diff(np.append(first, n))
    entries = table.column("entry").combine_chunks().take(pa.array(first)).fill_null(START).to_numpy()
    given = table.column("ends").combine_chunks().take(pa.array(first)).to_pylist()
    ends = np.array([AT_END.tolist() if e is None else e for e in given], np.int64).reshape(-1, 4)
    last = table.column("last").combine_chunks().take(pa.array(first)).fill_null(True).to_numpy(zero_copy_only=False)
    classes = _classes(table)
    owner, row, letter, state, _ = solve(classes, lengths, entries, ends, last)
    # Insertions behind the last row of a conversation are placed at that row, after its own edit.
    place = first[owner] + np.minimum(row, lengths[owner] - 1)
    cls = classes[place]
    price = np.select([letter == _D, letter == _I, letter == _K], [DELETE, INSERT, _KEEP[cls]], _RELABEL[cls])
    due = np.array([USER if r == "u" else ASSISTANT for r in _DUE], object)[state]
    role = np.where((letter == _I) | (letter == _R), due, None)
    # Edits of one row in order.
    k = np.arange(len(place)) - np.searchsorted(place, place)
    return pa.table({"conv": conv.take(pa.array(place)), "block": table.column("block").take(pa.array(place)),
                     "at": table.column("at").take(pa.array(place)), "k": pa.array(k, pa.int32()),
                     "edit": pa.array([LETTERS[x] for x in letter], pa.string()),
                     "role": pa.array(role.tolist(), pa.string()), "cost": pa.array(price, pa.int64())})


def _type(df: DataFrame, name: str) -> str:
    return df.schema[name].dataType.simpleString()


def has_word(text: Column) -> Column:
    return text.rlike(WORD_CLASS)


def prepared(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
             text_col: str = "text", block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Rows in reading order with their faults, stored: (conv, turn, role, text, at, block, fault, initial, ...).

    Reading order: by turn, nulls first; rows of one turn by role and text
    hash.  A null role or text is one space.  Fault: the first of ``blank``,
    ``duplicate`` (role and text as in an earlier row), ``truncated``.
    """
    base = rows.select(F.col(conv_col).alias("conv"), F.col(turn_col).cast("long").alias("turn"),
                       F.coalesce(F.col(role_col), F.lit(" ")).alias("role"),
                       F.coalesce(F.col(text_col), F.lit(" ")).alias("text"))
    base = stored(base.select("*", F.sha2("text", 256).alias("h"), F.monotonically_increasing_id().alias("row")), "turns")
    place = F.struct(F.col("turn").isNotNull().alias("has"), F.coalesce("turn", F.lit(0)).alias("turn"), "row")
    again = (base.groupBy("conv", "role", "h").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n"))
             .where(F.col("n") > 1).select(F.col("conv").alias("c2"), F.col("role").alias("r2"), F.col("h").alias("h2"), "first"))
    found = base.join(again, F.col("conv").eqNullSafe(F.col("c2")) & (F.col("role") == F.col("r2"))
                      & (F.col("h") == F.col("h2")), "left")
    ended = F.substring(F.regexp_replace("text", r"[\x20\x09-\x0D]+\z", ""), -1, 1).isin(".", "!", "?")
    fault = (F.when(~has_word(F.col("text")), "blank").when(place > F.col("first"), "duplicate")
             .when(~ended, "truncated"))
    initial = F.substring("role", 1, 1)
    number = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3)
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = ["conv", "turn", "role", "h", "row"]
    placed = (found.select("conv", "turn", "role", "text", "h", "row", fault.alias("fault"), number.alias("initial"))
              .repartitionByRange(n, *order).sortWithinPartitions(*order)
              .withColumn("at", F.monotonically_increasing_id()).drop("h", "row"))
    return stored(placed.withColumns({
        "block": F.floor(F.col("at") / F.lit(block_rows)), "unended": F.coalesce(F.col("fault") == "truncated", F.lit(False)).cast("int"),
        "must_go": F.coalesce(F.col("fault").isin("blank", "duplicate"), F.lit(False))}), "placed")


def edits(placed: DataFrame) -> DataFrame:
    """The edits of the least cheapest repair: (conv, block, at, k, edit, role, cost), in order of (at, k).

    ``edit``: Keep, Rerole, Delete or Insert by initial; ``role``: the new role
    of R and I.  A row whose role begins with none of s, u, a cannot be kept.
    """
    ship_package(placed.sparkSession)
    conv = _type(placed, "conv")
    narrow = placed.select("conv", "block", "at", "initial", "unended", "must_go")
    several = (narrow.groupBy("conv").agg(F.min("block").alias("low"), F.max("block").alias("high"))
               .where(F.col("low") != F.col("high")).select(F.col("conv").alias("c2")))
    parts = narrow.join(several, F.col("conv").eqNullSafe(F.col("c2")), "left_semi")
    matrices = parts.groupBy("conv", "block").applyInArrow(
        _matrix_of, f"conv {conv}, block long, matrix array<long>")
    # One row per block of a conversation that lies in several: BLOCK_ROWS times fewer than rows.
    back = stored(matrices.groupBy("conv").applyInArrow(
        _costs_back, f"conv {conv}, block long, ends array<long>, last boolean"), "costs")

    def with_block(df: DataFrame, info: DataFrame, how: str) -> DataFrame:
        info = info.withColumnsRenamed({"conv": "c2", "block": "b2"})
        same = F.col("conv").eqNullSafe(F.col("c2")) & (F.col("block") == F.col("b2"))
        return df.join(info, same, how).drop("c2", "b2")

    exits = with_block(parts, back, "inner").groupBy("conv", "block").applyInArrow(
        _exits_of, f"conv {conv}, block long, exits array<long>")
    on = exits.groupBy("conv").applyInArrow(_states_on, f"conv {conv}, block long, entry long")
    told = with_block(back, on, "inner")
    return stored(with_block(narrow, stored(told, "states"), "left").groupBy("block").applyInArrow(
        _edits_of_block, f"conv {conv}, block long, at long, k int, edit string, role string, cost long"), "edits")


def repaired(placed: DataFrame, made: DataFrame) -> DataFrame:
    """The rows of the repaired conversations: (conv, at, k, role, text, edit), in order of (at, k)."""
    texts = placed.select("at", F.col("role").alias("had"), "text")
    kept = made.where(F.col("edit") != "D").join(texts, "at", "left")
    return kept.select("conv", "at", "k", F.coalesce("role", "had").alias("role"),
                       F.when(F.col("edit") == "I", "").otherwise(F.col("text")).alias("text"), "edit")


def _lag(column: str, by: str, order: str) -> Column:
    from pyspark.sql import Window
    return F.lag(column).over(Window.partitionBy(by).orderBy(order))


def audits(placed: DataFrame, made: DataFrame) -> DataFrame:
    """Per conversation with rows: faults, gaps, illegal neighbours, cost and audit."""
    turns = (placed.where(F.col("turn").isNotNull()).groupBy("conv", "turn").agg(F.lit(1).alias("one"))
             .groupBy("conv").agg((F.max("turn") - F.min("turn") + 1 - F.count(F.lit(1))).alias("gaps")))
    faults = placed.groupBy("conv").agg(*[F.count_if(F.col("fault") == name).alias(name)
                                          for name in ("blank", "duplicate", "truncated")])
    # Neighbours within blocks first, then across the blocks of a conversation.
    letters = "array_join(transform(array_sort(collect_list(struct(at, initial))), x -> x.initial), '')"
    inside = placed.groupBy("conv", "block").agg(F.expr(letters).alias("seq"))
    pairs = F.expr("size(filter(transform(sequence(1, greatest(length(seq) - 1, 1)), i -> substring(seq, i, 2)),"
                   " p -> length(p) = 2 and p not in ('01', '12', '21')))")
    across = F.concat(_lag("tail", "conv", "block"), F.substring("seq", 1, 1))
    illegal = (inside.select("conv", "block", "seq", F.substring("seq", -1, 1).alias("tail"), pairs.cast("long").alias("within"))
               .withColumn("across", F.coalesce(~across.isin("01", "12", "21"), F.lit(False)).cast("long"))
               .groupBy("conv").agg(F.sum(F.col("within") + F.col("across")).alias("illegal")))
    spelled = made.groupBy("conv", "block").agg(F.sum("cost").alias("cost"), F.expr(
        "array_join(transform(array_sort(collect_list(struct(at, k, edit))), x -> x.edit), '')").alias("audit"))
    whole = spelled.groupBy("conv").agg(F.sum("cost").alias("cost"), F.expr(
        "array_join(transform(array_sort(collect_list(struct(block, audit))), x -> x.audit), '')").alias("audit"))
    out = faults
    for other in (turns, illegal, whole):
        other = other.withColumnRenamed("conv", "c2")
        out = out.join(other, F.col("conv").eqNullSafe(F.col("c2")), "left").drop("c2")
    return out.withColumn("gaps", F.coalesce("gaps", F.lit(0)))


def _digester(conv_type: pa.DataType):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, digest, started = None, None, False
        for batch in small_batches(batches, 1024):
            done: list = []
            for conv, role, text in zip(batch.column("conv").to_pylist(), batch.column("role").to_pylist(), batch.column("text")):
                if not started or conv != current:
                    if started:
                        done.append((current, digest.hexdigest()))
                    current, digest, started = conv, hashlib.sha256(), True
                else:
                    digest.update(b"\n")
                digest.update(f"{role}:".encode())
                digest.update(text.as_py().encode())
            if done:
                yield pa.RecordBatch.from_arrays([pa.array([c for c, _ in done], conv_type), pa.array([d for _, d in done])],
                                                 names=["conv", "repaired_sha256"])
        if started:
            yield pa.RecordBatch.from_arrays([pa.array([current], conv_type), pa.array([digest.hexdigest()])],
                                             names=["conv", "repaired_sha256"])
    return run


def digests(rows: DataFrame) -> DataFrame:
    """SHA-256 of each repaired conversation (``role:text`` joined by newlines); rows pass through a task as a stream."""
    from pyspark.sql.pandas.types import to_arrow_type
    ship_package(rows.sparkSession)
    order = ["conv", "at", "k"]
    sorted_rows = rows.select(*order, "role", "text").repartition("conv").sortWithinPartitions(*order)
    return sorted_rows.mapInArrow(_digester(to_arrow_type(rows.schema["conv"].dataType)),
                                  f"conv {_type(rows, 'conv')}, repaired_sha256 string")


def damaged(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
            text_col: str = "text") -> DataFrame:
    """``rows`` as faulty as logs are, by the CRC-32 of ``id:turn`` modulo 20; a null is read as one space.

    0: dropped, 1: emptied, 2: without marks that end sentences, 3: there twice, 4: said by the user.
    """
    read = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in (conv_col, turn_col, role_col, text_col)]
    kind = F.crc32(F.concat(read[0], F.lit(":"), read[1]).cast("binary")) % 20
    return (rows.select(conv_col, turn_col, kind.alias("kind"), read[2].alias(role_col), read[3].alias(text_col))
            .where(F.col("kind") != 0)
            .select(conv_col, turn_col, F.when(F.col("kind") == 4, USER).otherwise(F.col(role_col)).alias(role_col),
                    F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace(text_col, "[.!?]", ""))
                    .otherwise(F.col(text_col)).alias(text_col),
                    F.explode(F.array_repeat(F.lit(1), F.when(F.col("kind") == 3, 2).otherwise(1))).alias("copy"))
            .drop("copy"))


def repair_conversations(rows: DataFrame, **options) -> tuple[DataFrame, DataFrame]:
    """(repaired rows, audits) of all conversations in ``rows``; see ``prepared`` and ``edits``.

    Rows without a conversation id are one conversation.  Repeated rows are
    duplicates.  Columns other than the named ones are not read.  An empty
    table gives empty results; a conversation all of whose rows go has an
    audit and no rows.
    """
    placed = prepared(rows, **options)
    made = edits(placed)
    return repaired(placed, made), audits(placed, made)
