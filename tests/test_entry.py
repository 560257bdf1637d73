import __spark_entry__ as e


def test_only_absence_leaves_a_module_out(tmp_path, monkeypatch):
    (tmp_path / "here.py").write_text("x = 1")
    (tmp_path / "broken.py").write_text("import not_installed_anywhere")
    (tmp_path / "gone" / "__pycache__").mkdir(parents=True)
    monkeypatch.syspath_prepend(str(tmp_path))
    assert e._present("here").x == 1
    assert e._present("not_there") is None and e._present("not_there.module") is None and e._present("gone.module") is None
    try:
        e._present("broken")
    except ImportError:
        return
    raise AssertionError("a fault inside a module must be an error")


def test_names():
    assert set(e.oracle_sql()) <= set(e.queries())
