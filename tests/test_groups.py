"""Components by shared keys: right, and with little written a round."""

import random

import pytest

from simquarry.operators import groups, ingest


def _least(pairs):
    """Least member tied to each, by following keys until nothing changes."""
    label = {m: m for m, _ in pairs}
    while True:
        least = {}
        for m, k in pairs:
            if k is not None:
                least[k] = min(least.get(k, m), label[m], label.get(least.get(k, m), m))
        new = {m: min([label[m]] + [least[k] for n, k in pairs if n == m and k is not None]) for m in label}
        if new == label:
            return label
        label = new


def _pairs(seed):
    rnd = random.Random(seed)
    rows = [(rnd.randrange(60), rnd.randrange(50) if rnd.random() < 0.9 else None) for _ in range(90)]
    chain = [(m, 1000 + k) for k in range(30) for m in (100 + k, 101 + k)]
    return rows + chain + [(7, 3), (7, 3), (900, None), (901, 2000)]


@pytest.mark.parametrize("seed", [1, 2])
def test_connected(make, seed):
    pairs = _pairs(seed)
    got = {r["member"]: r["component"] for r in groups.connected(make("member long, key long", *pairs)).collect()}
    assert got == _least(pairs)


def test_connected_without_keys(make):
    got = groups.connected(make("member string, key string", ("b", None), ("a", "x"), ("b", None))).collect()
    assert sorted(tuple(r) for r in got) == [("a", "a"), ("b", "b")]


def test_rounds_shrink(make, monkeypatch):
    """Twenty keys of a component in a row: written rows stay within a few times the pairs."""
    written = []

    def counted(df, freeze=groups.freeze):
        out = freeze(df)
        written.append(out.count())
        return out

    monkeypatch.setattr(groups, "freeze", counted)
    rnd = random.Random(5)
    pairs = []
    for c in range(20):
        names = rnd.sample(range(c * 100, c * 100 + 100), 21)
        pairs += [(m, c * 100 + k) for k in range(20) for m in names[k : k + 2]]
    groups.connected(make("member long, key long", *pairs)).collect()
    assert sum(written) <= 4 * len(pairs)


def test_documents_are_tied_by_numbers(make, monkeypatch):
    seen = []
    monkeypatch.setattr(ingest, "connected", lambda pairs, connected=ingest.connected: seen.append(pairs.dtypes) or connected(pairs))
    docs = make("doc string, simulation_id long, alias string, owner_id long, hash string", ("d1", None, "a", 1, "h"), ("d2", None, "", 1, "h"))
    sims = make("id long, alias string, created_by_id long, unique_file_hash_string string", (5, "a", 1, "g"))
    got = ingest.resolve_simulations(docs, sims).select("doc", "step", "sim_id").collect()
    assert sorted(tuple(r) for r in got) == [("d1", "alias", 5), ("d2", "hash", 5)]
    assert seen == [[("member", "bigint"), ("key", "bigint")]]
