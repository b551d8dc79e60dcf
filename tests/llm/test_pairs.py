"""Hard negatives, near-duplicate vectors and repaired conversations against brute force."""

import hashlib
import itertools
import random
import zlib

import numpy as np
import pytest

from docketlake.llm import conversations, negatives, smallworld

rng = np.random.default_rng(5)


# -- hard negatives


@pytest.mark.parametrize("low, high", [(-256, 256), (0, 1), (-1, 0), (-(2**30), 2**29)])
def test_lookups_give_the_inner_products(low, high):
    a, c = rng.integers(low, high + 1, (70, 24)), rng.integers(low, high + 1, (90, 24))
    assert (negatives.scores(negatives.subset_sums(a), negatives.bit_planes(c)) == c @ a.T).all()


def mined(rows, s):
    """Brute force over (id, label, vector, is_anchor)."""
    sound = sorted((i, lab, [int(np.floor(s.scale * float(x))) for x in v], a) for i, lab, v, a in rows if None not in (i, lab, v) and all(x is not None and np.isfinite(x) for x in v))
    one = {}
    for r in sound:
        one.setdefault(r[0], r)
    out = []
    for i, lab, v, a in one.values():
        if not a:
            continue
        scored = sorted((-sum(x * y for x, y in zip(v, w)), j, m) for j, m, w, _ in one.values() if j != i)
        for p, j, m in [x for x in scored if x[2] == lab][: s.positives]:
            hard = [x for x in scored if x[2] != lab and -s.low * p <= -100 * x[0] <= -s.high * p][: s.negatives]
            out += [(i, j, k + 1, x[1], -p, -x[0]) for k, x in enumerate(hard)]
    return sorted(out)


def test_negatives_equal_brute_force(spark):
    rows = [(i, int(rng.integers(4)), [float(np.float32(x)) for x in rng.normal(0.1, 0.3, 19)], i % 5 == 0) for i in range(150)]
    rows += [(200 + i, 1, rows[3][2], i == 0) for i in range(30)]  # a hot vector: ties go by id
    rows += [(3, 0, rows[5][2], False), (3, 0, rows[5][2], False), rows[10], (500, None, [1.0], True), (501, 2, None, True), (None, 2, [0.5], True), (502, 2, [0.5, None], True), (503, 2, [float("nan")], True), (504, 2, [float("inf")], True), (505, 2, [0.5, 0.25], True), (506, 3, [], True)]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id long, label int, embedding array<float>, anchor boolean, cell string, rank int")
    for s in (negatives.Settings(anchors=8, candidates=16), negatives.Settings(positives=2, negatives=50, low=10, high=99)):
        got = negatives.mine(df, df.anchor, settings=s).collect()
        assert sorted(map(tuple, got)) == mined(rows, s)
    assert not negatives.mine(df.limit(0), df.anchor).collect()


# -- near-duplicate vectors


def linked(rows, least=0.9):
    """Brute force over (id, vector): rows of (id, links, component)."""
    sound = [(i, np.pad(np.array(v, dtype=float), (0, 24 - len(v)))) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    x = np.array([v / np.linalg.norm(v) for _, v in sound])
    near = x @ x.T >= least
    parent = {i: i for i, _ in rows}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in zip(*np.nonzero(near)):
        a, b = find(sound[a][0]), find(sound[b][0])
        parent[max(a, b)] = min(a, b)
    links = {id(r): 0 for r in rows}
    told = sorted([(i, int(n) - 1, find(i)) for (i, _), n in zip(sound, near.sum(axis=1))], key=str)
    rest = [(i, 0, find(i) if i is not None else None) for i, v in rows if not (i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v))]
    assert links
    return sorted(told + rest, key=str)


def vectors(n=400, d=24, near=0.05):
    base = rng.normal(size=(n, d))
    rows = [(i, v.tolist()) for i, v in enumerate(base)]
    rows += [(1000 + i, (base[i % 40] + near * rng.normal(size=d) * np.linalg.norm(base[i % 40]) / np.sqrt(d)).tolist()) for i in range(150)]
    rows += [(2000 + i, (base[0] + 0.02 * rng.normal(size=d)).tolist()) for i in range(200)]  # a hot group of near copies
    return rows + [(3000 + i, base[7].tolist()) for i in range(50)] + [(3100, (2.5 * base[7]).tolist()), (3101, (-base[7]).tolist())]


def test_links_and_components_equal_brute_force_over_many_shards(spark):
    rows = vectors()
    odd = [(4000, None), (4001, []), (4002, [0.0] * 24), (4003, [1.0, None]), (4004, [float("nan")] * 24), (4005, [float("inf")] * 24), (None, [1.0] * 24), (4006, [1.0, 2.0]), (4007, [2.0, 4.0, 0.0]), (5, rows[9][1]), (5, rows[9][1])]
    df = spark.createDataFrame([(i, v, 1, "x") for i, v in rows + odd], "vec_id long, embedding array<double>, links int, key string")
    found = smallworld.near_vectors(df, settings=smallworld.Settings(shard=150, audited=60))
    got = sorted(((r.vec_id, r.n_links, r.component_id) for r in found.links.collect()), key=str)
    assert got == linked(rows + odd)
    assert all(r.kept == (r.vec_id == r.component_id or r.vec_id is None) for r in found.links.collect())
    shards = found.recall.collect()
    assert len(shards) > 4 and sum(r.found_links for r in shards) >= 0.999 * sum(r.audited_links for r in shards) > 0


def test_no_vectors(spark):
    assert not smallworld.near_vectors(spark.createDataFrame([], "vec_id long, embedding array<float>")).links.collect()
    one = smallworld.near_vectors(spark.createDataFrame([(1, None)], "vec_id long, embedding array<float>")).links.collect()
    assert [tuple(r) for r in one] == [(1, 0, 1, True)]


def test_the_graph_does_the_finding():
    """Searches look at a small part of a shard, and without links they find nothing beyond the first row."""
    x = smallworld._units(rng.normal(size=(3000, 24)))
    s = smallworld.Settings()
    top = np.sort(smallworld.layers(rng.integers(-(2**62), 2**62, 3000), s.links))[::-1]
    graph = smallworld.build(x, top, s)
    assert graph.sizes[0] == 3000 and 100 < graph.sizes[1] < 500
    seen = np.zeros((50, 3000), dtype=bool)
    graph.beam(0, graph.x[:50], graph.descend(graph.x[:50], 0, 4), 32, seen)
    assert seen.mean() < 0.5
    at, rows = graph.near(graph.x[1000:1100], 32, 0.9, 0.05)
    assert set(zip(at.tolist(), (rows - 1000).tolist())) >= {(i, i) for i in range(100)}
    bare = smallworld.Graph(x, [np.full_like(links, -1) for links in graph.links])
    assert len(bare.near(bare.x[1000:1100], 32, 0.9, 0.05)[0]) == 0


# -- conversations

WHITE = " \t\n\x0b\x0c\r"


def hurt(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        k = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        text = "" if k == 1 else "".join(c for c in text if c not in ".!?") if k == 2 else text
        out += [(conv, turn, "user" if k == 4 else role, text)] * (0 if k == 0 else 2 if k == 3 else 1)
    return out


def legal(roles):
    roles = roles[1:] if roles[:1] == "s" and roles[1:] else roles
    return len(roles) % 2 == 0 and all(r == "ua"[i % 2] for i, r in enumerate(roles))


def brute(rows):
    """Every edit script of a few turns, cheapest first, then least as text."""
    seen, faults = set(), []
    for _, _, role, text in rows:
        bare = text.strip(WHITE)
        faults.append("b" if not bare else "d" if (role, text) in seen else "t" if bare[-1] not in ".!?" else "")
        seen.add((role, text))
    told = []
    inserts = [(), ("user",), ("assistant",), ("user", "assistant"), ("assistant", "user")]
    for ops in itertools.product("DKR", repeat=len(rows)):
        if any(f in ("b", "d") and o != "D" for f, o in zip(faults, ops)):
            continue
        for new in itertools.product(inserts, repeat=len(rows) + 1):
            for roles in itertools.product(*[("user", "assistant") if o == "R" else (None,) for o in ops]):
                audit, made, cost = "", [], 0
                for i in range(len(rows) + 1):
                    audit, cost = audit + "I" * len(new[i]), cost + 2 * len(new[i])
                    made += [(r, "") for r in new[i]]
                    if i < len(rows):
                        audit += ops[i]
                        cost += {"D": 3, "K": 0, "R": 2}[ops[i]] + (faults[i] == "t" and ops[i] != "D")
                        if ops[i] != "D":
                            made.append((roles[i] or rows[i][2], rows[i][3]))
                if legal("".join((r or "?")[:1] for r, _ in made)):
                    told.append((cost, audit, hashlib.sha256("\n".join(f"{r}:{t}" for r, t in made).encode()).hexdigest()))
    cost, audit, digest = min(told)
    turns = [t for _, t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum((a[2][:1] + b[2][:1]) not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    return gaps, faults.count("b"), faults.count("d"), faults.count("t"), illegal, cost, audit, digest


def test_repairs_equal_all_edit_scripts(spark, monkeypatch):
    rnd = random.Random(3)
    texts = ["Yes.", "No!", "and so", " \t", "", None, "Why? ", "fine\x0b", "Yes."]
    rows = [(c, t if rnd.random() < 0.9 else None, rnd.choice(["user", "assistant", "system", "user", "assistant", "tool", "", None]), rnd.choice(texts)) for c in range(60) for t in range(0, 2 * rnd.randrange(4), rnd.choice([1, 2]))]
    rows += [(None, 1, "user", "Who?"), (None, 2, "assistant", "I."), (77, None, None, None)]
    rows = list({(c, t): (c, t, r, x) for c, t, r, x in rows}.values())  # one row a turn: ties have an order of their own
    given = spark.createDataFrame([(*r, "x", 1) for r in rows], "conv_id long, turn long, role string, text string, block string, at int").repartition(3)
    got = {r.conv_id: tuple(r)[1:] for r in conversations.summaries(conversations.repair(conversations.damaged(given), given)).collect()}
    after = hurt(rows)
    assert set(got) == {r[0] for r in rows}
    for c in got:
        own = sorted((r for r in after if r[0] == c), key=lambda r: (r[1] is not None, r[1] or 0))
        if len(own) <= 4:
            assert got[c] == brute(own), own
    assert sum(len([r for r in after if r[0] == c]) <= 4 for c in got) > 40


def whole(codes):
    """Dynamic programming with whole edit texts."""
    best = {0: (0, "")}
    for c in codes:
        new = {}
        for s, (cost, text) in best.items():
            for t, (more, word) in conversations.moves(c)[s].items():
                new[t] = min(new.get(t, (1e9, "")), (cost + more, text + word))
        best = new
    return min((cost + 2 * conversations.END[s], text + "I" * conversations.END[s]) for s, (cost, text) in best.items())


def test_halves_meet_in_the_least_text():
    rnd = random.Random(9)
    for n in [0, 1, 2, 3, 7, 40, 400]:
        for _ in range(40 if n < 100 else 5):
            codes = "".join(rnd.choice("suaoxSUAO") for _ in range(n))
            if codes:
                words, last = conversations.solve(codes, 0, conversations.ends())
                assert "".join(words) + "I" * conversations.END[last] == whole(codes)[1]


def test_blocks_of_a_long_conversation_meet_likewise(spark):
    """One conversation over many tasks, with a turn that is repeated thousands of times and turns without a number."""
    rnd = random.Random(4)
    rows = [(1, t, rnd.choice(["user", "assistant", "tool"]), rnd.choice(["Yes.", f"{t}?", f"{t}", " "])) for t in range(3000)]
    rows += [(1, 50, "user", "Again.")] * 2000 + [(1, None, "system", "Be kind.")] + [(2, 1, "user", "Hi."), (2, 2, "assistant", "Ho.")]
    given = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(5)
    repaired = conversations.repair(given, given, block=700)
    assert repaired.audits.where("conv_id = 1").count() > 1
    got = {r.conv_id: r for r in conversations.summaries(repaired).collect()}
    ordered = sorted((r for r in rows if r[0] == 1), key=lambda r: (r[1] is not None, r[1] or 0, r[2], hashlib.sha256(r[3].encode()).digest()))
    seen, codes, illegal = set(), "", 0
    for a, b in zip([(None,) * 4, *ordered], ordered):
        bare, letter = b[3].strip(), b[2][0] if b[2][0] in "sua" else "o"
        codes += "x" if not bare or b[2:] in seen else letter if bare[-1] in ".!?" else letter.upper()
        seen.add(b[2:])
        illegal += a[2] is not None and a[2][0] + b[2][0] not in ("su", "ua", "au")
    cost, audit = whole(codes)
    assert (got[1].cost, got[1].audit, got[1].illegal, got[1].gaps) == (cost, audit, illegal, 0)
    kept = [(i, e) for i, e in enumerate(x for x in audit)]
    turns, lines, state = iter(ordered), [], 0
    for _, e in kept:
        row = next(turns) if e != "I" else None
        if e == "D":
            continue
        state = conversations.KEPT[state, row[2][0]] if e == "K" else conversations.MADE[state]
        lines.append(f"{row[2] if e == 'K' else conversations.ROLES[state]}:{row[3] if row else ''}")
    assert got[1].repaired_sha256 == hashlib.sha256("\n".join(lines).encode()).hexdigest()
    assert (got[2].audit, got[2].cost, got[2].repaired_sha256) == ("KK", 0, hashlib.sha256(b"user:Hi.\nassistant:Ho.").hexdigest())


def test_no_conversations(spark):
    none = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert not conversations.summaries(conversations.repair(conversations.damaged(none), none)).collect()
    one = spark.createDataFrame([(3, 1, "user", "x")], "conv_id long, turn long, role string, text string")
    got = conversations.summaries(conversations.repair(one.limit(0), one)).collect()
    assert [tuple(r) for r in got] == [(3, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]
