from wavemeter.llm import workers


def test_what_another_kind_kept_is_dropped(monkeypatch):
    monkeypatch.setattr(workers, "_held", None)
    dropped = []
    workers.hold("a", lambda: dropped.append("a"))
    workers.hold("a", lambda: dropped.append("again"))
    assert dropped == []
    workers.hold("b", lambda: dropped.append("b"))
    workers.hold("a", lambda: dropped.append("a"))
    assert dropped == ["a", "b"]
