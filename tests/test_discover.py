from __future__ import annotations

import pytest

from logframe import label_names, label_values, series
from tests.conftest import BASE_NS, SECOND

API = [("job", "=", "api")]
SHOP = [("job", "=", "shop")]


def values(df):
    return sorted(r[0] for r in df.collect())


def test_label_names(seeded, logs):
    assert label_names(seeded).columns == ["label"]
    assert values(label_names(seeded)) == ["job", "level"]
    ragged = logs([(1, "a", {"x": "1"}), (2, "b", {"y": "1", "x": "2"}), (3, "c", {})])
    assert values(label_names(ragged)) == ["x", "y"]
    assert values(label_names(ragged, end=2)) == ["x"]
    assert values(label_names(ragged, start=3)) == []


def test_label_values(seeded):
    assert label_values(seeded, "job").columns == ["value"]
    assert values(label_values(seeded, "job")) == ["mail", "shop"]
    assert values(label_values(seeded, "level", selector=SHOP)) == ["fatal", "info", "warn"]
    assert values(label_values(seeded, "level", selector=SHOP, end=BASE_NS + 2 * SECOND)) == ["info", "warn"]
    assert values(label_values(seeded, "absent")) == []
    for name in (None, ""):
        with pytest.raises(ValueError, match="label name"):
            label_values(seeded, name)


@pytest.mark.parametrize("promote", [(), ("job",)])
def test_series(logs, promote):
    table = logs(
        [
            (1, "a", {"job": "api", "level": "error"}),
            (2, "b", {"level": "error", "job": "api"}),
            (3, "c", {"job": "api"}),
            (4, "d", {"job": "web", "odd": 'quote " and \x1f and \\ é'}),
        ],
        promote,
    )
    found = series(table, [("job", "=~", ".+")])
    assert found.columns == ["labels"]
    assert sorted(map(sorted, (r.labels.items() for r in found.collect()))) == sorted(
        map(
            sorted,
            (
                {"job": "api", "level": "error"}.items(),
                {"job": "api"}.items(),
                {"job": "web", "odd": 'quote " and \x1f and \\ é'}.items(),
            ),
        )
    )
    promoted = series(table, API, labels=["level", "job"])
    assert promoted.columns == ["level", "job", "labels"]
    assert sorted((r.level or "", r.job) for r in promoted.collect()) == [("", "api"), ("error", "api")]
    for selector in (None, [], [("job", "!=", "x")]):
        with pytest.raises(ValueError, match="selector"):
            series(table, selector)
