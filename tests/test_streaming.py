import json

from dialoom.sources.archive import Archive
from dialoom.streaming import ingest


def talk(i):
    return {"uuid": f"k{i}", "name": "n", "updated_at": "2024-01-02T00:00:00Z", "chat_messages": [{"uuid": f"m{i}", "sender": "human", "text": "hi"}]}


def test_new_files_once(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    archive = Archive(spark, str(tmp_path / "archive"))
    archive.init()
    for n in range(2):
        (folder / f"{n}.json").write_text(json.dumps([talk(n)]))
        ingest.import_new(archive, str(folder), "claude").awaitTermination()
        assert archive.load("dialogues").count() == n + 1 and archive.load("messages").count() == n + 1
