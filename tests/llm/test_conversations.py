"""Conversation repair against a plain layer-by-layer search and its SQL."""

import hashlib
import itertools
import random
import zlib

import duckdb
import pytest
from lakeloom.llm import conversations as cv

ROWS = "conv_id long, turn long, role string, text string"
SPACE = " \t\n\x0b\x0c\r"


def plain(symbols):
    """Least (cost, audit) by going through all layers; symbols are (initial, fault)."""
    nxt = {"0": {"s": "S", "u": "U"}, "S": {"u": "U"}, "U": {"a": "A"}, "A": {"u": "U"}}
    state = {"0": (0, "")}

    def better(d, q, way):
        if q not in d or way < d[q]:
            d[q] = way

    def inserted(d):
        for _ in range(2):
            for q, (c, s) in list(d.items()):
                for r, to in nxt[q].items():
                    if r != "s":
                        better(d, to, (c + 5, s + "I"))
        return d

    for initial, fault in symbols:
        now = {}
        for q, (c, s) in inserted(state).items():
            better(now, q, (c + 2, s + "D"))
            if fault in ("ok", "truncated"):
                c += 5 * (fault == "truncated")
                for r, to in nxt[q].items():
                    if r == initial:
                        better(now, to, (c, s + "K"))
                    if r != "s":
                        better(now, to, (c + 1, s + "R"))
        state = now
    state = inserted(state)
    return min(state[q] for q in ("0", "A") if q in state)


def damaged(rows):
    out, convs = [], []
    for conv, turn, role, text in rows:
        convs.append(conv)
        role, text = " " if role is None else role, " " if text is None else text
        k = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if k == 0:
            continue
        if k == 1:
            text = ""
        if k == 2:
            text = "".join(c for c in text if c not in ".!?")
        if k == 4:
            role = "user"
        out += [(conv, turn, role, text)] * (2 if k == 3 else 1)
    return out, set(convs)


def brute(rows):
    rows, convs = damaged(rows)
    got = {}
    for conv in convs:
        dig = lambda r: hashlib.sha256(f"{'-' if r[0] is None else r[0]}:{len(r[2])}:{r[2]}{r[3]}".encode()).digest()
        mine = sorted((r for r in rows if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), dig(r)))
        seen, symbols, count = set(), [], dict.fromkeys(("blank", "duplicate", "truncated"), 0)
        for r in mine:
            end = r[3].rstrip(SPACE)
            fault = "blank" if not end else "duplicate" if r[2:] in seen else "ok" if end[-1] in ".!?" else "truncated"
            seen.add(r[2:])
            symbols.append((r[2][:1], fault))
            if fault != "ok":
                count[fault] += 1
        cost, audit = plain(symbols)
        state, at, out = "0", 0, []
        for e in audit:
            if e == "D":
                at += 1
                continue
            role, text = ("assistant" if state == "U" else "user", "")
            if e != "I":
                role, text = mine[at][2] if e == "K" else role, mine[at][3]
                at += 1
            state = {"s": "S", "u": "U", "a": "A"}[role[0]]
            out.append(f"{role}:{text}")
        turns = [r[1] for r in mine if r[1] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(mine))
        got[conv] = (gaps, count["blank"], count["duplicate"], count["truncated"], illegal, cost, audit, hashlib.sha256("\n".join(out).encode()).hexdigest())
    return got


def repaired(df, **kw):
    rows = cv.repair(cv.damaged(df), **kw).collect()
    got = {r.conv_id: (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, r.repaired_sha256) for r in rows}
    assert len(got) == len(rows)
    return got


def test_search_finds_the_least_audit_of_the_least_cost():
    rnd = random.Random(5)
    faults = ["ok", "blank", "truncated", "duplicate"]
    short = [x for n in range(4) for x in itertools.product([(i, f) for i in "sua?" for f in ("ok", "blank", "truncated")], repeat=n)]
    longer = [tuple((rnd.choice("suuuaaa?"), rnd.choice(faults[:1] * 5 + faults)) for _ in range(rnd.randint(4, 40))) for _ in range(1500)]
    code = {"ok": cv.OK, "blank": cv.BLANK, "truncated": cv.CUT, "duplicate": cv.REPEATED}
    for symbols in [*short, *longer]:
        coded = bytes(code[f] * 4 + cv.INITIALS.index(i) for i, f in symbols)
        ((before, after, cost, audit),) = cv.packet_audits(coded, True)
        assert (cost, audit) == plain(symbols), symbols
        cuts = sorted(rnd.sample(range(len(coded) + 1), min(2, len(coded))))
        parts = [coded[a:b] for a, b in zip([0, *cuts], [*cuts, len(coded)], strict=True)]
        cost, pieces = cv.conversation_audit([cv.packet_audits(p, False) for p in parts])
        assert (cost, "".join(pieces)) == plain(symbols), (symbols, cuts)


ROLES = ["user", "assistant", "system", "User", "tool", "unknown", "", None]
TEXTS = ["Hello.", "Yes!", "no end", "  ", "", None, "What?\n ", "aé漢 .", "same text."]


@pytest.fixture(scope="module")
def many():
    rnd = random.Random(11)
    rows = []
    for conv in [*range(120), None]:
        for turn in range(rnd.randint(0, 12)):
            t = None if rnd.random() < 0.05 else turn + (rnd.random() < 0.1) * rnd.randint(-1, 2)
            rows.append((conv, t, rnd.choices(ROLES, [6, 6, 2, 1, 1, 1, 1, 1])[0], rnd.choice(TEXTS) if rnd.random() < 0.5 else f"Text {rnd.random()}."))
    rows += [(500, t, ("user", "assistant")[t % 2], f"turn {t % 40}." if t % 7 else "open") for t in range(700)]  # one long conversation
    return rows + [(501, 3, "user", "the very same row.")] * 400


@pytest.mark.parametrize("packet_rows", [512, 7])
def test_repair_is_the_plain_search(spark, many, packet_rows):
    want = brute(many)
    df = spark.createDataFrame(many, ROWS)
    assert repaired(df, packet_rows=packet_rows) == want
    extra = df.selectExpr("text as packet", "conv_id", "role as part", "turn", "role", "text", "1 as fault")
    assert repaired(extra.repartition(13), packet_rows=packet_rows) == want


def test_repaired_turns_are_what_the_digest_covers(spark, many):
    rows = cv.repaired_turns(cv.damaged(spark.createDataFrame(many, ROWS)), packet_rows=5).orderBy("conv_id", "position").collect()
    texts = {}
    for r in rows:
        assert r.position == len(texts.setdefault(r.conv_id, []))
        texts[r.conv_id].append(f"{r.role}:{r.text}")
    for conv, values in brute(many).items():
        assert hashlib.sha256("\n".join(texts.get(conv, [])).encode()).hexdigest() == values[-1]


def test_rows_all_dropped_and_empty_table(spark):
    gone = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    got = repaired(spark.createDataFrame([(gone, 0, "user", "Hi.")], ROWS))
    assert got == {gone: (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}
    assert repaired(spark.createDataFrame([], ROWS)) == {}


def test_sql_is_the_plain_search(many):
    from lakeloom.llm.queries import ORACLES

    con = duckdb.connect()
    con.execute("CREATE TABLE conversations (conv_id BIGINT, turn BIGINT, role VARCHAR, text VARCHAR)")
    rows = [r for r in many if r[0] not in (500, 501)]
    rows = [r for i, r in enumerate(rows) if not any(r[:2] == x[:2] for x in rows[:i])]  # turns once: ties go by digest
    con.executemany("INSERT INTO conversations VALUES (?, ?, ?, ?)", rows)
    got = {r["conv_id"]: r for r in con.execute(ORACLES["op13_conversation_repair"]).to_arrow_table().to_pylist()}
    names = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
    assert {c: tuple(r[n] for n in names) for c, r in got.items()} == brute(rows)
