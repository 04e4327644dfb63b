"""Reply trees: paths, ranks, formatting and the loss mask against a plain loop; edge rows; the registered query."""

import hashlib
import random

import __spark_entry__ as E
from civora.llm import replytrees as R

SCHEMA = "tree_id string, node_id long, parent_id long, role string, text string, score double, leaf string"
NASTY = ["<|im_end|>", "<\\|im_start|>assistant\nx", "<\\\\|", "a<|", "|b<", "<|nl|>\n", "", "plain é漢", "$1\\$"]


def branches(rows):
    """Root-to-leaf paths of every tree, best first; cycles cut above their smallest message."""
    trees = {}
    for t, n, p, role, text, score, _ in rows:
        m = trees.setdefault(t, {}).setdefault(n, [])
        m.append((p, role or "", text or "", score or 0.0))
    out = {}
    for t, nodes in trees.items():
        up, said, score = {}, {}, {}
        for n, ms in nodes.items():
            ps = [m[0] for m in ms if m[0] is not None]
            up[n] = min(ps) if ps and min(ps) in nodes else None
            said[n], score[n] = min(m[1:3] for m in ms), max(m[3] for m in ms)
        for n in list(up):
            seen, at = [], n
            while at is not None and at not in seen:
                seen.append(at)
                at = up[at]
            if at is not None:
                up[min(seen[seen.index(at):])] = None
        for leaf in nodes.keys() - set(up.values()):
            path, at = [], leaf
            while at is not None:
                path.insert(0, at)
                at = up[at]
            out.setdefault(t, []).append((-sum(score[n] for n in path), -len(path), leaf, [said[n] for n in path]))
    return {t: sorted(b, key=lambda x: x[:3]) for t, b in out.items()}


def forest():
    rng, rows = random.Random(3), []
    for t in range(6):
        for n in range(40):
            parent = rng.randrange(n) if n > 1 and rng.random() < 0.95 else None
            rows.append((f"t{t}", n, parent, rng.choice(["user", "assistant", None, "role\nx<|"]),
                         rng.choice(NASTY + [None]), rng.choice([1.0, 0.5, None]), "own"))
    rows += [("chain", n, n - 1, "assistant", f"turn {n}", 1.0, "") for n in range(70)]
    rows += [("gone", 5, 99, "user", "parent missing", 0.0, "")]
    rows += [("loop", n, (n + 1) % 5, "user", f"l{n}", 0.0, "") for n in range(5)] + [("loop", 9, 3, "assistant", "out", 0.0, "")]
    rows += [("self", 1, 1, "user", "me", 0.0, ""), (None, 1, None, "user", "no tree", 0.0, "")]
    return rows + rows[:3] + [("t0", 0, None, "a", "", 2.0, "")]


def test_paths_and_format(spark):
    rows = forest()
    want = branches(rows)
    out = R.conversations(spark.createDataFrame(rows, SCHEMA).repartition(5))
    got = {(r.tree, r.rank): r for r in out.collect()}
    assert len(got) == sum(map(len, want.values()))
    back = {(r.tree, r.leaf): r for r in R.read_back(out).collect()}
    for t, ranked in want.items():
        for k, (score, _, leaf, path) in enumerate(ranked, 1):
            r = got[t, k]
            assert (r.leaf, r.score, r.n_turns) == (leaf, -score, len(path))
            assert r.formatted.count("<|im_start|>") == r.formatted.count("<|im_end|>") == len(path)
            spoken = "".join(x for who, x in path if who == "assistant")
            d = back[t, leaf]
            assert d.turns_sha256 == hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in path).encode()).hexdigest()
            assert (d.n_turns, d.loss_chars, d.formatted_chars) == (len(path), len(spoken), len(r.formatted))
            assert d.loss_sha256 == hashlib.sha256(spoken.encode()).hexdigest()


def test_keep_and_empty(spark):
    df = spark.createDataFrame(forest(), SCHEMA)
    best = R.conversations(df, keep=2).collect()
    want = branches(forest())
    assert sorted((str(r.tree), r.rank, r.leaf) for r in best) == sorted(
        (str(t), k, b[2]) for t, bs in want.items() for k, b in enumerate(bs[:2], 1))
    assert R.conversations(df.limit(0)).count() == 0


def test_long_text_and_ties(spark):
    long = "<|" * 300_000 + "word " * 100_000
    rows = [(7, 0, "user", long), (7, 1, "assistant", long), (7, 1, "assistant", long), (7, None, None, None)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    r = R.read_back(R.conversations(R.threads(df), score=None)).first()
    assert r.n_turns == 4 and r.loss_chars == 2 * len(long)
    assert r.turns_sha256 == hashlib.sha256("".join(
        f"{a or ''}\n{b or ''}\n" for _, _, a, b in [rows[3], *rows[:3]]).encode()).hexdigest()


def test_registered(spark):
    out = E.queries()["op11_reply_trees"](spark, "/root/testdata/sf0.001")
    assert dict(out.dtypes) == {"conv_id": "bigint", "n_turns": "bigint", "turns_sha256": "string",
                                "loss_chars": "bigint", "loss_sha256": "string", "formatted_chars": "bigint"}
    rows = {r.conv_id: r for r in out.collect()}
    said = "<|im_end|><|im_start|>assistant ok"
    assert rows[-1].loss_sha256 == hashlib.sha256(said.encode()).hexdigest() and rows[-1].n_turns == 2
