import json

import pytest

from corpusmix import load_recipe, parse_recipe
from corpusmix.sources.recipe import eval_rows, parse_directions, parse_ratio

CONTENT = {
    "instruction_data": {"chat": {"path": "c", "language": "cy"}},
    "translation_data": {
        "pairs": {"path": "p", "usage": 0.1, "directions": ["en_cy", " CY-EN ", "en-cy"]},
        "unused": {"path": "u", "usage": 0, "config": "cy-en"},
    },
    "dictionary_data": {"terms": {"path": "d", "usage": 1}},
    "meta_strategy": {"target_ratio": [7, 3], "eval_size": 0.01, "max_seq_len": 512},
}


def test_sections_have_a_fixed_order_and_unused_sources_are_dropped():
    recipe = parse_recipe(CONTENT)
    assert [(e.section, e.name, e.source_ord) for e in recipe.entries] == [
        ("translation", "pairs", 0),
        ("translation", "unused", 1),
        ("dictionary", "terms", 2),
        ("instruction", "chat", 3),
    ]
    assert [e.name for e in recipe.active_entries] == ["pairs", "terms", "chat"]
    assert recipe.entries[0].directions == ("en-cy", "cy-en")
    assert recipe.entries[3].language == "cy"
    assert recipe.entries[3].usage == 1.0
    assert recipe.max_tokens == 512
    assert (recipe.translation_share, recipe.instruction_share) == (0.7, 0.3)


def test_recipe_file_and_frame(spark, tmp_path):
    path = tmp_path / "recipe.json"
    path.write_text(json.dumps(CONTENT), encoding="utf-8")
    frame = load_recipe(str(path)).to_frame(spark)
    assert frame.where("usage > 0").count() == 3
    assert frame.where("section = 'instruction'").first()["directions"] is None


def test_defaults():
    recipe = parse_recipe({"translation_data": {"a": {"path": "p"}}})
    assert recipe.entries[0].directions == ("en-cy",)
    assert (recipe.translation_share, recipe.eval_size, recipe.max_tokens) == (0.7, 1000, 2048)


def test_directions_are_checked():
    assert parse_directions(["CY_en", "cy-en"]) == ("cy-en",)
    with pytest.raises(ValueError, match="fr-en"):
        parse_directions(["fr-en"])


def test_ratio():
    assert parse_ratio("60: 40") == (0.6, 0.4)
    assert parse_ratio([1, 1]) == (0.5, 0.5)
    with pytest.raises(ValueError, match="above zero"):
        parse_ratio("100:0")
    with pytest.raises(ValueError, match="needs"):
        parse_ratio("100")


def test_eval_rows():
    assert eval_rows(1000, 1_354_653) == 1000
    assert eval_rows(0.05, 200) == 10
    assert eval_rows(0.5, 5) == 2  # halves go to the even number
    assert eval_rows(1000, 10) == 9
    assert eval_rows(0, 10) == 1
    assert eval_rows(1.0, 10) == 9
    with pytest.raises(ValueError, match="share"):
        eval_rows(1.5, 10)


def test_usage_must_be_a_share():
    with pytest.raises(ValueError, match="usage"):
        parse_recipe({"translation_data": {"a": {"path": "p", "usage": 1.5}}})
