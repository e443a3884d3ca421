import json
import os

import pytest

from lodestrata.__main__ import main

DATA = "/root/testdata/sf0.001"


def test_commands(spark, capsys, tmp_path):
    assert main(["queries"]) == 0
    assert "address_scale" in json.loads(capsys.readouterr().out)
    assert main(["validate", str(tmp_path / "none")]) == 1
    assert json.loads(capsys.readouterr().out)["error"] == "FileNotFoundError"


@pytest.mark.skipif(not os.path.isdir(DATA), reason="needs the test tables")
def test_publish(spark, capsys, tmp_path):
    root = str(tmp_path / "art")
    assert main(["publish", DATA, root]) == 0
    files = json.loads(capsys.readouterr().out)["files"]
    assert files and main(["validate", root]) == 0
    assert json.loads(capsys.readouterr().out)["files"] == files
    assert main(["publish", DATA, root]) == 1
    capsys.readouterr()
    assert main(["run", "address_scale", DATA]) == 0
    assert json.loads(capsys.readouterr().out)["address_count"] > 0
    assert main(["audit", "points", DATA]) == 0
    assert json.loads(capsys.readouterr().out)["points"] > 0
    assert main(["probe", "address_scale", DATA]) == 0
    assert json.loads(capsys.readouterr().out)["bytes"] > 0


def test_groups_name_queries():
    from lodestrata.__main__ import GROUPS
    from lodestrata.plans.registry import QUERIES

    assert {q for actions in GROUPS.values() for q in actions.values()} <= set(QUERIES)
