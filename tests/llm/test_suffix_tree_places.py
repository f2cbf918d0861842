import numpy as np

from presswork.llm import suffix_tree


def test_places_are_looked_up_in_order(monkeypatch):
    rng = np.random.default_rng(2)
    search, seen = np.searchsorted, []
    monkeypatch.setattr(suffix_tree.np, "searchsorted", lambda keys, wanted, **more: seen.append(wanted) or search(keys, wanted, **more))
    low, high = np.iinfo(np.int64).min, np.iinfo(np.int64).max
    for keys in (np.unique(rng.integers(-60, 60, 50)), np.array([low, 0, high]), np.array([5]), np.zeros(0, np.int64)):
        place = {k: i for i, k in enumerate(keys.tolist())}
        for wanted in (rng.integers(-70, 70, 500), np.array([high, low, 0, high, 5]), np.zeros(0, np.int64)):
            assert suffix_tree._places(keys, wanted).tolist() == [place.get(w, -1) for w in wanted.tolist()]
    assert seen and all((np.diff(w.astype(float)) >= 0).all() for w in seen)
