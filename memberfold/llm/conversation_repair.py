"""Cheapest repair of conversations, by dynamic programming over runs of equal symbols.

A turn's role initial and fault make its symbol. What a symbol costs from state to state of
the wanted order of roles is a small matrix over (min, +); a run of equal symbols is a power
of it, put together from cached binary powers. Costs are carried backwards over runs, then
choices are unrolled forwards, each the ASCII-least of the cheapest.

A conversation of any length is handled in pieces: a piece is one matrix to the others, so
that costs and states at its ends are known without its turns.
"""

from __future__ import annotations

import functools
import hashlib
import itertools
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from memberfold.llm.common import small, written

SPACES = " \t\n\x0b\x0c\r"
# Turns and characters of a piece; a longer turn is a piece of its own.
PIECE_TURNS, PIECE_CHARS = 4096, 1 << 20
KEEP, REROLE, DELETE, INSERT = 0, 2, 3, 2
TRUNCATED = 1
# States: nothing yet, after the system, after a user, after an assistant.
START, SYSTEM, USER, ASSISTANT = range(4)
# The state that a user's or assistant's turn, new or with a new role, leads to.
SPOKEN = (USER, USER, ASSISTANT, USER)
ROLE = {USER: "user", ASSISTANT: "assistant"}
FAR = 1 << 50
# Cost of ending in each state: nothing at all and an assistant's turn need no insertion.
END = (0, 2 * INSERT, INSERT, 0)
# Symbols: a role's initial (`o`: any other), in capitals if truncated; `x` has to go.
GONE = "x"


def kept(symbol: str, state: int) -> int | None:
    """The state after a turn that stays as it is, if it may."""
    role = symbol.lower()
    if role == "s" and state == START:
        return SYSTEM
    if role == "u" and SPOKEN[state] == USER:
        return USER
    if role == "a" and SPOKEN[state] == ASSISTANT:
        return ASSISTANT
    return None


def product(a: tuple, b: tuple) -> tuple:
    return tuple(
        tuple(min(a[i][k] + b[k][j] for k in range(4)) for j in range(4)) for i in range(4)
    )


def applied(a: tuple, ahead: tuple) -> tuple:
    return tuple(min(a[i][k] + ahead[k] for k in range(4)) for i in range(4))


IDENTITY = tuple(tuple(0 if i == j else FAR for j in range(4)) for i in range(4))


@functools.cache
def transition(symbol: str) -> tuple:
    """Costs from state to state over insertions, if any, and one turn."""
    inserted = [list(row) for row in IDENTITY]
    for state in range(4):
        inserted[state][SPOKEN[state]] = min(inserted[state][SPOKEN[state]], INSERT)
    inserted = product(tuple(map(tuple, inserted)), tuple(map(tuple, inserted)))
    turn = [[DELETE if i == j else FAR for j in range(4)] for i in range(4)]
    if symbol != GONE:
        more = TRUNCATED if symbol.isupper() else 0
        for state in range(4):
            to = SPOKEN[state]
            turn[state][to] = min(turn[state][to], REROLE + more)
            to = kept(symbol, state)
            if to is not None:
                turn[state][to] = min(turn[state][to], KEEP + more)
    return product(inserted, tuple(map(tuple, turn)))


@functools.cache
def power(symbol: str, exponent: int) -> tuple:
    """The transition over 2 ** exponent turns of one symbol."""
    if not exponent:
        return transition(symbol)
    half = power(symbol, exponent - 1)
    return product(half, half)


def runs(symbols: str) -> list[tuple[str, int]]:
    return [(symbol, sum(1 for _ in group)) for symbol, group in itertools.groupby(symbols)]


def _binary(n: int) -> Iterator[int]:
    return (k for k in range(n.bit_length()) if n >> k & 1)


def behind(symbols: str, ahead: tuple) -> list[tuple]:
    """Costs to the end before each run, and after the last."""
    out = [ahead]
    for symbol, n in reversed(runs(symbols)):
        for exponent in _binary(n):
            ahead = applied(power(symbol, exponent), ahead)
        out.append(ahead)
    return out[::-1]


def summary(symbols: str) -> tuple:
    """The transition over all symbols."""
    total = IDENTITY
    for symbol, n in runs(symbols):
        for exponent in _binary(n):
            total = product(total, power(symbol, exponent))
    return total


def _edits(symbols: str, state: int, ahead: tuple, last: bool) -> tuple[str, int]:
    """The ASCII-least cheapest edits, and the state after them."""
    out = []
    costs = behind(symbols, ahead)
    for (symbol, n), after in zip(runs(symbols), costs[1:]):
        left = [after]
        for _ in range(n):
            left.append(applied(transition(symbol), left[-1]))
        more = TRUNCATED if symbol.isupper() else 0
        while n:
            rest, spoken = left[n][state], SPOKEN[state]
            stays = kept(symbol, state) if symbol != GONE else None
            if DELETE + left[n - 1][state] == rest:
                edit = "D"
            elif INSERT + left[n][spoken] == rest:
                edit, state = "I", spoken
            elif stays is not None and KEEP + more + left[n - 1][stays] == rest:
                edit, state = "K", stays
            else:
                edit, state = "R", spoken
            out.append(edit)
            n -= edit != "I"
    while last and END[state]:
        out.append("I")
        state = SPOKEN[state]
    return "".join(out), state


_short_edits = functools.lru_cache(100_000)(_edits)


def edits(symbols: str, state: int = START, ahead: tuple = END, last: bool = True) -> tuple[str, int]:
    if len(symbols) <= 32:
        return _short_edits(symbols, state, ahead, last)
    return _edits(symbols, state, ahead, last)


def repaired(audit: str, state: int, symbols: str, roles: list[str], texts: list[str]):
    """The turns that the edits leave or make, as role and text; and what the edits cost."""
    turns, cost, at = [], 0, 0
    for edit in audit:
        if edit == "D":
            cost += DELETE
        elif edit == "I":
            cost += INSERT
            state = SPOKEN[state]
            turns.append((ROLE[state], ""))
        else:
            cost += (REROLE if edit == "R" else KEEP) + (TRUNCATED if symbols[at].isupper() else 0)
            state = SPOKEN[state] if edit == "R" else kept(symbols[at], state)
            turns.append((ROLE[state] if edit == "R" else roles[at], texts[at]))
        at += edit != "I"
    return turns, cost


def damaged(conversations: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text, live``: rows with faults put in, by crc32 of `conv_id:turn`.

    Of twenty remainders 0 drops a row, 1 empties its text, 2 removes its `.`, `!` and `?`,
    3 repeats it, 4 makes its role user. A dropped row stays as one that is not ``live``, so
    that its conversation is still known. A null stands for one space, but in ``turn`` itself.
    """
    blank = F.lit(" ")
    key = [F.coalesce(F.col(c).cast("string"), blank) for c in ("conv_id", "turn")]
    kind = F.crc32(F.concat(key[0], F.lit(":"), key[1])) % 20
    rows = conversations.select(
        F.col("conv_id").cast("long"),
        F.col("turn").cast("long"),
        F.coalesce("role", blank).alias("role"),
        F.coalesce("text", blank).alias("text"),
        kind.alias("kind"),
    )
    is_kind = lambda k: F.col("kind") == k
    text = F.when(is_kind(1), "").when(is_kind(2), F.translate("text", ".!?", "")).otherwise(F.col("text"))
    copies = F.array_repeat(F.lit(0), F.when(is_kind(3), 2).otherwise(1))
    live = ~is_kind(0)
    return rows.select(
        "conv_id",
        F.when(live, F.col("turn")).alias("turn"),
        F.when(live, F.when(is_kind(4), "user").otherwise(F.col("role"))).alias("role"),
        F.when(live, text).alias("text"),
        live.alias("live"),
        F.explode(copies).alias("copy"),
    ).drop("copy")


_PIECE = (
    "conv_id long, part long, at long, whole boolean, flaws string, "
    "turns array<long>, roles array<string>, texts array<string>"
)
_KINDS = {
    "long": pa.int64(),
    "boolean": pa.bool_(),
    "string": pa.string(),
    "array<long>": pa.list_(pa.int64()),
    "array<string>": pa.list_(pa.string()),
}


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    fields = [f.split(" ") for f in schema.split(", ")]
    columns = list(zip(*rows)) if rows else [[]] * len(fields)
    arrays = [pa.array(c, _KINDS[kind]) for c, (_, kind) in zip(columns, fields)]
    return pa.RecordBatch.from_arrays(arrays, names=[name for name, _ in fields])


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(c.to_pylist() for c in batch.columns))


def _batches(rows: Iterator[tuple], schema: str, size) -> Iterator[pa.RecordBatch]:
    """Batches of about a piece's characters, by the size that each row is said to have."""
    held, total = [], 0
    for row in rows:
        held.append(row)
        total += size(row) + 100
        if total > PIECE_CHARS:
            yield _batch(held, schema)
            held, total = [], 0
    yield _batch(held, schema)


def _packed(rows: Iterator[tuple]) -> Iterator[tuple]:
    """Pieces of the sorted turns of a partition, whole conversations where they fit.

    The first and the last conversation of a partition may go on in another one.
    """
    part, at = TaskContext.get().partitionId(), 0
    open_id, whole, chars, turns, roles, texts, flaws = None, None, 0, [], [], [], []
    for conv_id, turn, role, text, live, flaw in rows:
        changed = conv_id != open_id
        full = turns and (len(turns) >= PIECE_TURNS or chars + len(text or "") > PIECE_CHARS)
        if whole is not None and (changed or full):
            yield open_id, part, at, whole and changed, "".join(flaws), turns, roles, texts
            at, chars, turns, roles, texts, flaws = at + 1, 0, [], [], [], []
            whole = changed
        if whole is None:
            whole = False
        open_id = conv_id
        if live:
            turns.append(turn)
            roles.append(role)
            texts.append(text)
            flaws.append(flaw)
            chars += len(text)
    if whole is not None:
        yield open_id, part, at, False, "".join(flaws), turns, roles, texts


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    return _batches(_packed(_rows(batches)), _PIECE, lambda row: sum(map(len, row[7])))


def pieces(rows: DataFrame) -> DataFrame:
    """Sorted turns in pieces of bounded size, from ``conv_id, turn, role, text, live``.

    Rows are dealt by ranges of conversation and turn, equal ones by their number, so that
    neither a long conversation nor a turn repeated very often has to be in one place.
    """
    bare = F.rtrim(F.col("text"), F.lit(SPACES))
    flaw = F.when(bare == "", "b").when(F.right(bare, F.lit(1)).isin(".", "!", "?"), "-").otherwise("t")
    rows = rows.select("conv_id", "turn", "role", "text", "live", flaw.alias("flaw"))
    rows = rows.withColumn("number", F.monotonically_increasing_id())
    order = [F.col(c).asc_nulls_first() for c in ("conv_id", "turn", "role", "text", "number")]
    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order).drop("number")
    return written(dealt.mapInArrow(_pack, _PIECE), "pieces")


def marked(flaws: str, roles: list[str], first: list[bool]) -> str:
    """Symbols of turns: `x` for what is blank or not the first of its kind."""
    out = []
    for flaw, role, new in zip(flaws, roles, first):
        initial = role[:1] if role[:1] in ("s", "u", "a") else "o"
        out.append(GONE if flaw == "b" or not new else initial.upper() if flaw == "t" else initial)
    return "".join(out)


def _first_here(roles: list[str], texts: list[str]) -> list[bool]:
    seen = set()
    return [not (pair in seen or seen.add(pair)) for pair in zip(roles, texts)]


_SUMMARY = "conv_id long, part long, at long, firsts array<long>, symbols string, costs array<long>"


def _summarized(rows: Iterator[tuple]) -> Iterator[tuple]:
    for conv_id, part, at, flaws, roles, firsts in rows:
        new = set(firsts or ())
        symbols = marked(flaws, roles, [k in new for k in range(len(roles))])
        yield conv_id, part, at, sorted(new), symbols, [c for row in summary(symbols) for c in row]


_AHEAD = "conv_id long, part long, at long, firsts array<long>, symbols string, ahead array<long>, exits array<long>, last boolean"


def _looked_ahead(rows: Iterator[tuple]) -> Iterator[tuple]:
    """From a conversation's last piece to its first: costs after it, and where it leads to."""
    for _, group in itertools.groupby(rows, key=lambda row: row[0]):
        ahead, last = END, True
        for conv_id, part, at, firsts, symbols, costs in group:
            exits = [edits(symbols, state, ahead, last)[1] for state in range(4)]
            yield conv_id, part, at, firsts, symbols, list(ahead), exits, last
            ahead = applied(tuple(tuple(costs[4 * i : 4 * i + 4]) for i in range(4)), ahead)
            last = False


_PLAN = "part long, at long, firsts array<long>, symbols string, ahead array<long>, entry long, last boolean"


def _entered(rows: Iterator[tuple]) -> Iterator[tuple]:
    for _, group in itertools.groupby(rows, key=lambda row: row[0]):
        state = START
        for _, part, at, firsts, symbols, ahead, exits, last in group:
            yield part, at, firsts, symbols, ahead, state, last
            state = exits[state]


def _mapped(df: DataFrame, kernel, schema: str, size=lambda row: 0) -> DataFrame:
    return df.mapInArrow(lambda batches: _batches(kernel(_rows(batches)), schema, size), schema)


def planned(parted: DataFrame) -> DataFrame:
    """What each piece of a conversation in several pieces has to know of the others."""
    turns = parted.select(
        "conv_id", "part", "at", F.posexplode(F.arrays_zip("roles", "texts")).alias("pos", "turn")
    )
    place = F.struct("part", "at", "pos")
    firsts = turns.groupBy("conv_id", "turn.roles", F.sha2("turn.texts", 256))
    firsts = firsts.agg(F.min(place).alias("first")).select("first.*").groupBy("part", "at")
    firsts = firsts.agg(F.collect_list(F.col("pos").cast("long")).alias("firsts"))
    known = parted.select("conv_id", "part", "at", "flaws", "roles").join(firsts, ["part", "at"], "left")
    known = known.select("conv_id", "part", "at", "flaws", "roles", "firsts")
    summaries = _mapped(known, _summarized, _SUMMARY, lambda row: len(row[4]))
    back = [F.asc_nulls_first("conv_id"), F.desc("part"), F.desc("at")]
    ahead = summaries.repartition("conv_id").sortWithinPartitions(*back)
    ahead = _mapped(ahead, _looked_ahead, _AHEAD, lambda row: len(row[4]))
    on = [F.asc_nulls_first("conv_id"), F.asc("part"), F.asc("at")]
    entered = ahead.repartition("conv_id").sortWithinPartitions(*on)
    return written(_mapped(entered, _entered, _PLAN, lambda row: len(row[3])), "plan")


def placed_pieces(rows: DataFrame) -> DataFrame:
    """Pieces with their symbols, costs ahead, state at entry, and if they are the last."""
    found = pieces(rows)
    plan = planned(found.where("NOT whole"))
    none = {name: F.lit(None).cast(kind) for name, kind in (f.split(" ") for f in _PLAN.split(", ")[2:])}
    return found.where("whole").withColumns(none).unionByName(
        found.where("NOT whole").join(small(plan), ["part", "at"])
    )


def _known(row: dict) -> tuple[list[bool], str, str, int]:
    """Which turns are the first of their kind, the symbols, edits and state at entry."""
    if row["symbols"] is None:
        first = _first_here(row["roles"], row["texts"])
        symbols = marked(row["flaws"], row["roles"], first)
        return first, symbols, edits(symbols)[0], START
    new = set(row["firsts"])
    first = [k in new for k in range(len(row["roles"]))]
    audit, _ = edits(row["symbols"], row["entry"], tuple(row["ahead"]), row["last"])
    return first, row["symbols"], audit, row["entry"]


_TURN = "conv_id long, part long, at long, turn long, role string, text string"


def _as_turns(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            _, symbols, audit, state = _known(row)
            turns, _ = repaired(audit, state, symbols, row["roles"], row["texts"])
            place = row["conv_id"], row["part"], row["at"]
            yield _batch([(*place, k, role, text) for k, (role, text) in enumerate(turns)], _TURN)


def repaired_turns(rows: DataFrame) -> DataFrame:
    """``conv_id, part, at, turn, role, text``: repaired conversations, a row a turn.

    ``part``, ``at`` and ``turn`` give the order within a conversation.
    """
    return placed_pieces(rows).mapInArrow(_as_turns, _TURN)


_FACTS = (
    "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"
)
_REPORT = f"conv_id long, {_FACTS}, repaired_sha256 string"
_FRAGMENT = (
    "conv_id long, part long, at long, whole boolean, n long, first_turn long, last_turn long, distinct long, "
    "blank long, duplicate long, truncated long, illegal long, cost long, "
    "audit string, starts string, ends string, body string"
)
LEGAL = {"su", "ua", "au"}


def _illegal(initials: list[str]) -> int:
    return sum(a + b not in LEGAL for a, b in itertools.pairwise(initials))


def _fragments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row a piece: counts, edits, and its repaired turns as text (whole: their sha256)."""

    def each() -> Iterator[tuple]:
        for row in (r for batch in batches for r in batch.to_pylist()):
            first, symbols, audit, state = _known(row)
            turns, cost = repaired(audit, state, symbols, row["roles"], row["texts"])
            body = "\n".join(f"{role}:{text}" for role, text in turns)
            body = f"\n{body}" if turns and not row["whole"] else body
            numbered = [t for t in row["turns"] if t is not None]
            blank = row["flaws"].count("b")
            duplicate = sum(f != "b" and not new for f, new in zip(row["flaws"], first))
            initials = [role[:1] for role in row["roles"]]
            yield (
                *(row[c] for c in ("conv_id", "part", "at", "whole")),
                len(initials),
                *((numbered[0], numbered[-1]) if numbered else (None, None)),
                len(set(numbered)),
                *(blank, duplicate, sum(s.isupper() for s in symbols), _illegal(initials)),
                cost,
                audit,
                *((initials[0], initials[-1]) if initials else (None, None)),
                hashlib.sha256(body.encode()).hexdigest() if row["whole"] else body,
            )

    return _batches(each(), _FRAGMENT, lambda row: len(row[13]) + len(row[16]))


def _gaps(first: int | None, last: int | None, distinct: int) -> int:
    return 0 if first is None else last - first + 1 - distinct


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row a conversation, from its pieces in order; of their texts one is held at a time."""

    def each() -> Iterator[tuple]:
        names = [f.split(" ")[0] for f in _FRAGMENT.split(", ")]
        rows = (dict(zip(names, row)) for row in _rows(batches))
        for conv_id, group in itertools.groupby(rows, key=lambda row: row["conv_id"]):
            sums = dict.fromkeys(("distinct", "blank", "duplicate", "truncated", "illegal", "cost"), 0)
            first = last = ends = None
            audit, body, empty = [], hashlib.sha256(), True
            for row in group:
                for name in sums:
                    sums[name] += row[name]
                if row["first_turn"] is not None:
                    sums["distinct"] -= last == row["first_turn"]
                    first = row["first_turn"] if first is None else first
                    last = row["last_turn"]
                if row["n"]:
                    sums["illegal"] += ends is not None and ends + row["starts"] not in LEGAL
                    ends = row["ends"]
                audit.append(row["audit"])
                if row["body"]:
                    body.update(row["body"][empty:].encode())  # no break before the first turn
                    empty = False
            yield (
                *(conv_id, _gaps(first, last, sums.pop("distinct")), *sums.values()),
                *("".join(audit), body.hexdigest()),
            )

    return _batches(each(), _REPORT, lambda row: len(row[7]))


def repair_report(rows: DataFrame) -> DataFrame:
    """Faults, cheapest edits and their result for each conversation.

    ``rows`` has ``conv_id, turn, role, text, live`` as ``damaged`` gives them; a row that is
    not live only names its conversation. Turns stand in the order of turn (nulls first), role
    and text. ``gaps`` counts missing turn numbers. A row's first fault counts: ``blank``
    (nothing but white space), ``duplicate`` (role and text seen earlier), ``truncated`` (last
    character that is no white space is not `.`, `!` or `?`). ``illegal`` counts neighbours
    whose role initials are not su, ua or au. ``audit`` holds the initials of the cheapest
    edits (Keep, Rerole, Delete, Insert) that give role initials `(s?(ua)+)?`, the ASCII-least
    of equal ones; ``repaired_sha256`` is that of the repaired `role:text` lines.

    A conversation without live rows has zeros, no edits and the hash of an empty text; the
    null conv_id is a conversation like any other. An empty table gives no rows; other
    columns are not looked at. A conversation of any length is sorted, searched and repaired
    in pieces in many tasks. Only the pieces' summaries and, since a sha256 and an audit are
    one value, the pieces' texts of one conversation pass one after the other through one
    task, which holds one of them at a time and the audit.
    """
    fragments = placed_pieces(rows).mapInArrow(_fragments, _FRAGMENT)
    fragments = written(fragments, "fragments")
    names = [f.split(" ")[0] for f in _REPORT.split(", ")]
    gaps = F.when(F.col("first_turn").isNull(), 0).otherwise(
        F.col("last_turn") - F.col("first_turn") + 1 - F.col("distinct")
    )
    whole = fragments.where("whole").withColumn("gaps", gaps.cast("long"))
    whole = whole.withColumnRenamed("body", "repaired_sha256").select(*names)
    order = [F.asc_nulls_first("conv_id"), F.asc("part"), F.asc("at")]
    parted = fragments.where("NOT whole").repartition("conv_id").sortWithinPartitions(*order)
    return whole.unionAll(parted.mapInArrow(_joined, _REPORT))
