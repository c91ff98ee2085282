"""Document stores for tests; a module of its own so that Python workers can import it."""

import json
import os


class FolderClient:
    """A document store in a folder: one JSON file per key."""

    def __init__(self, folder):
        self.folder = folder

    def _path(self, key):
        return os.path.join(self.folder, "_".join(str(v) for v in key.values()) + ".json")

    def replace_many(self, documents):
        for key, document in documents:
            with open(self._path(key), "w") as handle:
                json.dump(document, handle, default=str)

    def delete_many(self, keys):
        for key in keys:
            if os.path.exists(self._path(key)):
                os.remove(self._path(key))

    def close(self):
        pass


class FlakyClient(FolderClient):
    """Fails on its very first call."""

    def replace_many(self, documents):
        marker = os.path.join(self.folder, "failed")
        if not os.path.exists(marker):
            open(marker, "w").close()
            raise ConnectionError("first call fails")
        super().replace_many(documents)


class DownClient(FolderClient):
    def replace_many(self, documents):
        raise ConnectionError("down")
