import sys

from cairnflow.functions import registry


def test_modules_are_discovered_by_prefix(tmp_path, monkeypatch):
    package = tmp_path / "plugins_here"
    package.mkdir()
    (package / "__init__.py").write_text("found = []\n")
    (package / "check_a.py").write_text("from plugins_here import found\nfound.append('a')\n")
    (package / "other.py").write_text("raise AssertionError\n")
    monkeypatch.syspath_prepend(str(tmp_path))
    import plugins_here

    try:
        assert [m.__name__ for m in registry.discover(plugins_here, "check_")] == ["plugins_here.check_a"] and plugins_here.found == ["a"]
    finally:
        for name in [n for n in sys.modules if n.startswith("plugins_here")]:
            del sys.modules[name]
