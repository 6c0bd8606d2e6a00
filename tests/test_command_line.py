import pytest

from imagelab.__main__ import parser, run


def test_train_list_score_and_watch(spark, tree, tmp_path, capsys):
    common = ["--registry", str(tmp_path / "registry")]

    def call(*words):
        return run(spark, parser().parse_args([*common, *map(str, words)]))

    assert call("models").count() == 0
    learn = ["train", "--models", tmp_path / "m"]
    read = ["--images", tree, "--classes", "alpha,beta,gamma"]
    small = ["--features", tmp_path / "f16", "--size", 16]
    models = call(*learn, *read, *small, "--algorithm", "tree", "--rows-per-class", 9)
    assert [(r.idx, r.model) for r in models.collect()] == [(1, "Decision Tree")]
    call(*learn, *read, "--features", tmp_path / "f20", "--size", 20, "--scaling", "inception",
         "--predictor", "imagelab.functions.predictors:channel_averages")
    assert "3 images without features: undecodable" in capsys.readouterr().out
    call(*learn, *small, "--algorithm", "perceptron")  # from the table, without images
    listed = call("models").collect()
    assert [r.model for r in listed] == ["Logistic Regression", "Decision Tree", "Multilayer Perceptron"]

    for number in (1, 2):  # each model brings its own featurizer
        out, place = tmp_path / f"batch{number}", tmp_path / f"stream{number}"
        scored = call("score", "--images", tree, "--model", number, "--out", out)
        watched = call(
            "watch", "--images", tree, "--model", number, "--out", place, "--checkpoint", f"{place}-checkpoint"
        )
        counts = {tuple(r) for r in scored.collect()}
        assert counts == {tuple(r) for r in watched.collect()}
        assert sum(n for *_, n in counts) == 31 and (None, "undecodable", 3) in counts
    with pytest.raises(ValueError):
        call("score", "--images", tree, "--model", "two", "--out", tmp_path / "none")
