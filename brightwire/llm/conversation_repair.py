"""Repair of conversations' structure: the cheapest edits that give a legal sequence of roles.

A conversation's rows are ordered by turn (nulls first), then role and text. A row is blank (no visible character), else a
duplicate (an earlier row has its role and text), else truncated (its last visible character doesn't end a sentence), else
sound. Legal sequences of role initials are empty, or ``ua`` once or more after at most one ``s``. Edits: Keep a row (0),
Rerole it to user or assistant (3), Delete it (4; blank rows and duplicates must go), Insert an empty user or assistant row
(3); a truncated row that stays costs 3 more.

Tight arcs: nodes are (rows consumed, state of the sequence), arcs are edits. Minimum costs forward from the start and
backward from the ends tell which arcs lie on a cheapest path (forward + arc + backward = total). Starting with the set of
start nodes, each step takes the least letter of D, I, K, R on a tight arc out of the set, and goes to all nodes that this
letter reaches: so the edits found are the least in ASCII order of all cheapest ones.

A conversation of up to ``LONG_ROWS`` rows and ``LONG_BYTES`` bytes is repaired at once, streamed from sorted partitions. Longer ones
are cut into chunks by ranges of (conversation, order), so that no task holds one: a chunk's costs are a matrix (least cost
between states), a conversation's chunks multiply to the costs at all borders, each chunk gives its letters for every set of
states that may enter it, and a pass over the chunks' ends chains them. Only the hash, which has one order, is fed from
the chunks' finished texts by one task a conversation, a chunk at a time.

Defined results: null roles and texts count as one space; a null conv_id is a conversation; rows repeated outright are
duplicates; equal turns are ordered by role and text; a conversation without rows (all marked ``dropped``) has zeros, no
edits and the empty text's hash; an empty table gives no rows; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brightwire.llm.common import cut, partitions, sorted_groups, tidied

#: What a conversation that is repaired at once has at most, and a chunk of a longer one on average.
LONG_ROWS, LONG_BYTES = 20_000, 32_000_000
#: Tables of long conversations up to this number (40 bytes each) are broadcast; beyond it they are joined by a shuffle.
BROADCAST_ROWS = 500_000
RENAME, REMOVE, INSERT, UNFINISHED = 3, 4, 3, 3
SOUND, TRUNCATED, DUPLICATE, BLANK = range(4)
FAR = 1 << 50

#: States: nothing yet, after s, after ua, after u. A step is the state that an initial leads to.
START, SYSTEM, PAIR, USER = range(4)
STEPS = {"s": {START: SYSTEM}, "u": {START: USER, SYSTEM: USER, PAIR: USER}, "a": {USER: PAIR}}
LEGAL_PAIRS = frozenset(("su", "ua", "au"))
_WHITE = r"' \t\n\u000b\f\r'"

Costs = list[int]
Row = tuple[str, int]  # role's initial, fault


def ordered(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", dropped: Column | None = None) -> DataFrame:
    """(c_null, c, turn, role, text, dropped): what the repair reads of ``rows``."""
    space = lambda c: F.coalesce(F.col(c), F.lit(" "))
    key = F.col(conv).cast("long")
    return rows.select(
        key.isNull().cast("int").alias("c_null"), F.coalesce(key, F.lit(0)).alias("c"), F.col(turn).cast("long").alias("turn"),
        space(role).alias("role"), space(text).alias("text"), (F.lit(False) if dropped is None else dropped).alias("dropped"),
    )


def damaged(rows: DataFrame) -> DataFrame:
    """Conversations spoiled by a hash of their place: rows dropped, emptied, stripped of sentence ends, repeated, reroled. Dropped rows stay, marked."""
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    code = F.crc32(F.concat(space("conv_id"), F.lit(":"), space("turn")).cast("binary")) % 20
    rows = rows.select("conv_id", "turn", space("role").alias("role"), space("text").alias("text"), code.alias("code"))
    rows = rows.withColumn("text", F.when(F.col("code") == 1, "").when(F.col("code") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")))
    rows = rows.withColumn("role", F.when(F.col("code") == 4, "user").otherwise(F.col("role")))
    twice = F.explode(F.when(F.col("code") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))))
    return rows.select("conv_id", "turn", "role", "text", (F.col("code") == 0).alias("dropped"), twice.alias("copy")).drop("copy")


def _faulty(rows: DataFrame) -> DataFrame:
    """With ``fault``, but for duplicates, which need the other rows."""
    end = F.expr(f"trim(trailing {_WHITE} from text)")
    return rows.withColumn("fault", F.when(end == "", BLANK).when(F.right(end, F.lit(1)).isin(".", "!", "?"), SOUND).otherwise(TRUNCATED))


# costs: closed under insertions at a row's place, then moved over the row


def inserted(v: Costs) -> Costs:
    user = min(v[USER], min(v[START], v[SYSTEM], v[PAIR]) + INSERT)
    return [v[START], v[SYSTEM], min(v[PAIR], user + INSERT), user]


def before_inserted(b: Costs) -> Costs:
    user = min(b[USER], b[PAIR] + INSERT)
    return [min(b[START], user + INSERT), min(b[SYSTEM], user + INSERT), min(b[PAIR], user + INSERT), user]


def arcs(row: Row) -> list[tuple[str, int, int, int]]:
    """(letter, from, to, cost) of a row, in the letters' order."""
    initial, fault = row
    out = [("D", s, s, REMOVE) for s in range(4)]
    if fault in (BLANK, DUPLICATE):
        return out
    stays = UNFINISHED * (fault == TRUNCATED)
    out += [("K", s, t, stays) for s, t in STEPS.get(initial, {}).items()]
    return out + [("R", s, t, stays + RENAME) for x in "ua" for s, t in STEPS[x].items()]


_ARCS: dict[Row, list[tuple[str, int, int, int]]] = {(x, f): arcs((x, f)) for x in ("s", "u", "a", "?") for f in range(4)}
_INSERTS = [("I", s, t, INSERT) for x in "ua" for s, t in STEPS[x].items()]
END = before_inserted([0, FAR, 0, FAR])


def _of(row: Row) -> list[tuple[str, int, int, int]]:
    return _ARCS[row if row[0] in STEPS else ("?", row[1])]


def forward(v: Costs, rows: list[Row]) -> list[Costs]:
    """Least costs from the start at each row's place, and behind the last row (there before any insertion)."""
    out = []
    for row in rows:
        v = inserted(v)
        out.append(v)
        w = [FAR] * 4
        for _, s, t, cost in _of(row):
            if v[s] + cost < w[t]:
                w[t] = v[s] + cost
        v = w
    return [*out, v]


def backward(b: Costs, rows: list[Row]) -> list[Costs]:
    """Least costs to the end at each row's place, and behind the last row (``b`` itself)."""
    out = [b]
    for row in reversed(rows):
        w = [FAR] * 4
        for _, s, t, cost in _of(row):
            if b[t] + cost < w[s]:
                w[s] = b[t] + cost
        b = before_inserted(w)
        out.append(b)
    return out[::-1]


def walk(states: frozenset[int], rows: list[Row], f: list[Costs], b: list[Costs], total: int, last: bool) -> tuple[str, frozenset[int]]:
    """The least letters on tight arcs from ``states`` over all rows, and the states they lead to; behind the ``last`` row to an end."""
    letters, i, n = [], 0, len(rows)
    f = [*f[:-1], inserted(f[-1])] if last else f
    while i < n or last and not any(s in (START, PAIR) and f[i][s] == total for s in states):
        own = sorted([*(_of(rows[i]) if i < n else ()), *_INSERTS])
        found: dict[str, set[int]] = {}
        for letter, s, t, cost in own:
            if s in states and f[i][s] + cost + b[i + (letter != "I")][t] == total:
                found.setdefault(letter, set()).add(t)
        letter = min(found)
        letters.append(letter)
        states, i = frozenset(found[letter]), i + (letter != "I")
    return "".join(letters), states


def texts_of(letters: str, roles: list[str], texts: list[str], place: int, odd: int) -> list[str]:
    """The repaired ``role:text`` lines of a run of letters, from the ``place``-th row that stays; ``odd``: rows that stay are odd in number, so a system row leads."""
    out, i = [], 0
    for letter in letters:
        if letter != "D":
            role = ("user", "assistant")[(place - odd) % 2]
            out.append(f"{roles[i]}:{texts[i]}" if letter == "K" else f"{role}:{texts[i] if letter == 'R' else ''}")
            place += 1
        i += letter != "I"
    return out


def stays(letters: str) -> int:
    return len(letters) - letters.count("D")


_RESULT = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
_SHORT = f"c_null int, c long, {_RESULT}"
_NAMES = [f.split()[0] for f in _SHORT.split(", ")]
_ARROW = {"int": pa.int32(), "long": pa.int64(), "string": pa.string(), "binary": pa.binary(), "boolean": pa.bool_(), "array<long>": pa.list_(pa.int64()), "array<string>": pa.list_(pa.string())}


def _table(rows: list[tuple], ddl: str) -> pa.Table:
    fields = [f.split() for f in ddl.split(", ")]
    return pa.table({name: pa.array([r[k] for r in rows], _ARROW[kind]) for k, (name, kind) in enumerate(fields)})


def repaired(roles: list[str], texts: list[str], turns: list[int | None], faults: list[int]) -> tuple:
    """The result's values of one conversation, its rows in order."""
    seen: set[tuple[str, str]] = set()
    for i, row in enumerate(zip(roles, texts, strict=True)):
        if row in seen and faults[i] != BLANK:
            faults[i] = DUPLICATE
        seen.add(row)
    initials = [r[:1] for r in roles]
    rows = list(zip(initials, faults, strict=True))
    f, b = forward([0, FAR, FAR, FAR], rows), backward(END, rows)
    letters, _ = walk(frozenset((START,)), rows, f, b, b[0][START], True)
    known = {t for t in turns if t is not None}
    gaps = max(known) - min(known) + 1 - len(known) if known else 0
    lines = texts_of(letters, roles, texts, 0, stays(letters) % 2)
    illegal = sum(x + y not in LEGAL_PAIRS for x, y in zip(initials, initials[1:], strict=False))
    counts = [faults.count(k) for k in (BLANK, DUPLICATE, TRUNCATED)]
    return (gaps, *counts, illegal, b[0][START], letters, hashlib.sha256("\n".join(lines).encode()).hexdigest())


def _short(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Over rows sorted by conversation and order."""
    out = []
    for group in sorted_groups(batches, 2):
        key = (group.column("c_null")[0].as_py(), group.column("c")[0].as_py())
        kept = group.filter(pc.invert(group.column("dropped")))
        out.append((*key, *repaired(*(kept.column(c).to_pylist() for c in ("role", "text", "turn", "fault")))))
        if len(out) == 2000:
            yield from _table(out, _SHORT).to_batches()
            out = []
    yield from _table(out, _SHORT).to_batches()


# long conversations, by chunks

_KEY = ["c_null", "c"]
_AT = "c_null int, c long, chunk int"
_SUMMARY = f"{_AT}, matrix array<long>, counts array<long>, ends array<string>, turns array<long>"
_BORDERS = f"{_AT}, f array<long>, b array<long>, total long, last boolean, stats array<long>"
_WAYS = f"{_AT}, enter int, leave int, letters string"
_PATH = f"{_AT}, letters string, place long, stay long"
_BLOCKS = f"{_AT}, n long, block binary"
_HASHES = "c_null int, c long, repaired_sha256 string"


def _chunk_rows(group: pa.Table) -> tuple[list[Row], pa.Table]:
    group = group.sort_by("pos")
    return [(r[:1], f) for r, f in zip(group.column("role").to_pylist(), group.column("fault").to_pylist(), strict=True)], group


def _first(group: pa.Table, *names: str) -> list:
    return [group.column(n)[0].as_py() for n in names]


def _summary(group: pa.Table) -> pa.Table:
    """A chunk's cost matrix, counts and ends."""
    rows, group = _chunk_rows(group)
    initials, turns = [r[0] for r in rows], [t for t in group.column("turn").to_pylist() if t is not None]
    matrix = [c for s in range(4) for c in forward([FAR * (s != t) for t in range(4)], rows)[-1]]
    illegal = sum(x + y not in LEGAL_PAIRS for x, y in zip(initials, initials[1:], strict=False))
    counts = [sum(f == k for _, f in rows) for k in (BLANK, DUPLICATE, TRUNCATED)]
    ends = [turns[0], turns[-1], len(set(turns))] if turns else []
    return _table([(*_first(group, *_KEY, "chunk"), matrix, [*counts, illegal], [initials[0], initials[-1]], ends)], _SUMMARY)


def _borders(group: pa.Table) -> pa.Table:
    """Of a conversation's chunks: the costs before and behind each, and the conversation's counts."""
    chunks = group.sort_by("chunk").to_pylist()
    fs, bs = [[0, FAR, FAR, FAR]], [END]
    for c in chunks:
        m = c["matrix"]
        fs.append([min(FAR, *(fs[-1][s] + m[4 * s + t] for s in range(4))) for t in range(4)])
    for c in reversed(chunks):
        m = c["matrix"]
        bs.append([min(FAR, *(m[4 * s + t] + bs[-1][t] for t in range(4))) for s in range(4)])
    bs, total = bs[::-1], bs[-1][START]
    counts = [sum(c["counts"][k] for c in chunks) for k in range(4)]
    counts[3] += sum(x["ends"][1] + y["ends"][0] not in LEGAL_PAIRS for x, y in zip(chunks, chunks[1:], strict=False))
    own = [c["turns"] for c in chunks if c["turns"]]
    distinct = sum(t[2] for t in own) - sum(x[1] == y[0] for x, y in zip(own, own[1:], strict=False))
    gaps = own[-1][1] - own[0][0] + 1 - distinct if own else 0
    return _table([(c["c_null"], c["c"], c["chunk"], fs[i], bs[i + 1], total, i == len(chunks) - 1, [gaps, *counts]) for i, c in enumerate(chunks)], _BORDERS)


def _letters(rows: pa.Table, border: pa.Table) -> pa.Table:
    """For each set of states that may enter a chunk: the letters, and the states behind it."""
    own, rows = _chunk_rows(rows)
    f, b, total, last = _first(border, "f", "b", "total", "last")
    fs, bs = forward(f, own), backward(b, own)
    tight = [s for s in range(4) if f[s] + bs[0][s] == total]
    out, key = [], _first(rows, *_KEY, "chunk")
    for pick in range(1, 1 << len(tight)):
        enter = frozenset(s for k, s in enumerate(tight) if pick >> k & 1)
        letters, leave = walk(enter, own, fs, bs, total, last)
        out.append((*key, _mask(enter), _mask(leave), letters))
    return _table(out, _WAYS)


def _mask(states: frozenset[int]) -> int:
    return sum(1 << s for s in states)


def _chained(group: pa.Table) -> pa.Table:
    """Of a conversation: each chunk's letters on the path from the start, and the number of rows that stay before it and in all."""
    ways: dict[int, dict[int, tuple[int, str]]] = {}
    for r in group.sort_by("chunk").to_pylist():
        ways.setdefault(r["chunk"], {})[r["enter"]] = (r["leave"], r["letters"])
    states, place, out = 1 << START, 0, []
    for chunk, by in ways.items():
        states, letters = by[states]
        out.append((*_first(group, *_KEY), chunk, letters, place))
        place += stays(letters)
    return _table([(*row, place) for row in out], _PATH)


def _texts(rows: pa.Table, found: pa.Table) -> pa.Table:
    _, rows = _chunk_rows(rows)
    letters, place, stay = _first(found, "letters", "place", "stay")
    lines = texts_of(letters, rows.column("role").to_pylist(), rows.column("text").to_pylist(), place, stay % 2)
    return _table([(*_first(rows, *_KEY, "chunk"), len(lines), "\n".join(lines).encode())], _BLOCKS)


def _hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Over chunks' texts (key, n, block) sorted by conversation and chunk: the hash of each conversation."""
    now, state, begun, out = None, None, False, []
    for batch in batches:
        for r in range(batch.num_rows):
            key = (batch.column(0)[r].as_py(), batch.column(1)[r].as_py())
            if key != now:
                out += [(*now, state.hexdigest())] if now else []
                now, state, begun = key, hashlib.sha256(), False
            if batch.column(2)[r].as_py():
                state.update((b"\n" if begun else b"") + batch.column(3)[r].as_py())
                begun = True
    out += [(*now, state.hexdigest())] if now else []
    yield from _table(out, _HASHES).to_batches()


def _long(rows: DataFrame, n_rows: int, n_bytes: int) -> DataFrame:
    """Results of long conversations; rows that are dropped are not among ``rows``."""
    rows = cut(rows.withColumn("rid", F.monotonically_increasing_id()), "conversation-rows")
    digest = F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text")).alias("digest")
    firsts = rows.groupBy(*_KEY, digest).agg(F.min(F.struct(F.col("turn").isNotNull(), "turn", "rid"))["rid"].alias("first")).select("first")
    rows = rows.join(firsts, F.col("rid") == F.col("first"), "left")
    rows = rows.withColumn("fault", F.when(F.col("first").isNull() & (F.col("fault") != BLANK), DUPLICATE).otherwise(F.col("fault"))).drop("first")
    order = [*_KEY, F.asc_nulls_first("turn"), "role", "text", "rid"]
    chunks = max(partitions(rows.sparkSession), math.ceil(n_rows / LONG_ROWS), math.ceil(n_bytes / LONG_BYTES))
    dealt = rows.repartitionByRange(chunks, *order).sortWithinPartitions(*order)
    dealt = cut(dealt.withColumn("chunk", F.spark_partition_id()).withColumn("pos", F.monotonically_increasing_id()), "conversation-chunks")
    at = [*_KEY, "chunk"]
    borders = cut(dealt.groupBy(*at).applyInArrow(_summary, _SUMMARY).groupBy(*_KEY).applyInArrow(_borders, _BORDERS), "conversation-borders")
    ways = cut(dealt.groupBy(*at).cogroup(borders.groupBy(*at)).applyInArrow(_letters, _WAYS), "conversation-ways")
    path = cut(ways.groupBy(*_KEY).applyInArrow(_chained, _PATH), "conversation-path")
    blocks = cut(dealt.groupBy(*at).cogroup(path.groupBy(*at)).applyInArrow(_texts, _BLOCKS), "conversation-blocks")
    hashes = blocks.repartition(*_KEY).sortWithinPartitions(*at).select(*_KEY, "n", "block").mapInArrow(_hashes, _HASHES)
    audits = path.groupBy(*_KEY).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("chunk", "letters"))), lambda x: x["letters"]), "").alias("audit"))
    stats = borders.filter("last").select(*_KEY, *(F.col("stats")[k].alias(n) for k, n in enumerate(("gaps", "blank", "duplicate", "truncated", "illegal"))), F.col("total").alias("cost"))
    return stats.join(audits, _KEY).join(hashes, _KEY).select(*_NAMES)


def repair(rows: DataFrame, **names) -> DataFrame:
    """One row a conversation: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit (the edits' letters), repaired_sha256. ``names``: of the columns, and ``dropped``, of rows that don't count."""
    rows = _faulty(ordered(rows, **names))
    sizes = rows.groupBy(*_KEY).agg(F.count("*").alias("n"), F.sum(F.octet_length("text") + F.octet_length("role")).alias("bytes"))
    large = cut(sizes.filter((F.col("n") > LONG_ROWS) | (F.col("bytes") > LONG_BYTES)), "long-conversations")
    many, n_rows, n_bytes = large.agg(F.count("*"), F.sum("n"), F.sum("bytes")).first()
    own = F.broadcast(large) if many <= BROADCAST_ROWS else large
    short = rows.join(own, _KEY, "left_anti") if many else rows
    order = [*_KEY, F.asc_nulls_first("turn"), "role", "text"]
    short = short.repartition(partitions(rows.sparkSession), *_KEY).sortWithinPartitions(*order)
    out = short.mapInArrow(tidied(_short), _SHORT)
    if many:
        found = large.select(*_KEY).join(_long(rows.join(own.select(*_KEY), _KEY, "left_semi").filter("not dropped").drop("dropped"), n_rows, n_bytes), _KEY, "left")
        empty = {"audit": F.lit(""), "repaired_sha256": F.lit(hashlib.sha256(b"").hexdigest())}
        out = out.unionByName(found.withColumns({c: F.coalesce(c, empty.get(c, F.lit(0).cast("long"))) for c in _NAMES[2:]}))
    return out.select(F.when(F.col("c_null") == 0, F.col("c")).alias("conv_id"), *_NAMES[2:])
