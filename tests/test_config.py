import json

import pytest

from paperloom.config import FilterConfig, read_term_table, term_chunks

LISTS = {
    "categories": ["k", "l"],
    "core_terms": ["a", "b"],
    "adjacent_terms": ["c"],
    "exclude_terms": [],
}


def test_load_file(spark, tmp_path):
    path = tmp_path / "filters.json"
    path.write_text(json.dumps({**LISTS, "anchor_terms": ["é"], "note": 1}, indent=2))
    config = FilterConfig.load(spark, str(path))
    assert config.core_terms == ("a", "b")
    assert config.anchor_terms == ("é",)
    assert config.anchors == ("k", "l")
    assert config.keywords == ("a", "b", "c")
    rows = read_term_table(spark, str(path)).collect()
    assert {(r.tier, r.ordinal, r.term) for r in rows} == {
        ("categories", 0, "k"), ("categories", 1, "l"), ("core_terms", 0, "a"),
        ("core_terms", 1, "b"), ("adjacent_terms", 0, "c"), ("anchor_terms", 0, "é"),
    }
    assert sorted(map(tuple, config.term_table(spark).collect())) == sorted(map(tuple, rows))


def test_empty_lists_are_not_missing(spark):
    config = FilterConfig.from_mapping({**LISTS, "anchor_categories": [], "query_terms": []})
    assert config.anchors == ()
    assert config.keywords == ()


@pytest.mark.parametrize("name", LISTS)
def test_required_lists(name):
    with pytest.raises(KeyError, match=name):
        FilterConfig.from_mapping({k: v for k, v in LISTS.items() if k != name})


def test_shipped_config(spark):
    config = FilterConfig.shipped()
    assert len(config.categories) == 3
    assert len(config.keywords) == 23
    assert config.source_names() == [
        "category:quant-ph", "category:cs.IT", "category:math.IT",
        "keyword_chunk_1", "keyword_chunk_2", "keyword_chunk_3", "keyword_chunk_4",
    ]
    chunks = term_chunks(config.term_table(spark)).orderBy("ordinal").collect()
    assert [c.chunk for c in chunks] == [1] * 6 + [2] * 6 + [3] * 6 + [4] * 5
