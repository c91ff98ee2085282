"""Writing documents to an external keyed store, partition by partition."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterable, Iterator, Sequence
from itertools import islice
from typing import Protocol

from pyspark.sql import DataFrame, Row

# Attempts and the base of the waiting time (2 s, then 4 s).
ATTEMPTS = 3
WAIT_BASE = 2


class DocumentClient(Protocol):
    """What a store driver must offer; made on the executor by ``connect``."""

    def replace_many(self, documents: list[tuple[dict, dict]]) -> None:
        """Replace or insert each ``(key, document)`` as one bulk call."""

    def delete_many(self, keys: list[dict]) -> None:
        """Remove the documents with these keys, if present, as one bulk call."""

    def close(self) -> None: ...


def retrying(
    action: Callable[[], None],
    attempts: int = ATTEMPTS,
    base: float = WAIT_BASE,
    sleep: Callable[[float], None] = time.sleep,
) -> None:
    """Run an idempotent action, waiting ``base**n`` seconds after the n-th failure."""
    for attempt in range(1, attempts + 1):
        try:
            return action()
        except Exception:
            if attempt == attempts:
                raise
            sleep(base**attempt)


def _chunks(rows: Iterator[Row], size: int) -> Iterable[list[Row]]:
    while chunk := list(islice(rows, size)):
        yield chunk


def write_documents(
    documents: DataFrame,
    connect: Callable[[], DocumentClient],
    keys: Sequence[str],
    chunk_size: int = 500,
    attempts: int = ATTEMPTS,
    base: float = WAIT_BASE,
) -> None:
    """Replace or insert every row as a document.

    Each task sends its own rows in bulk calls; nothing passes through the driver.
    Replacing by key is idempotent, so a chunk may be sent again after a failure and
    a lost task may run again.
    """
    names = tuple(keys)

    def replace(client: DocumentClient, rows: list[dict]) -> None:
        client.replace_many([({name: row[name] for name in names}, row) for row in rows])

    documents.foreachPartition(_sender(connect, replace, chunk_size, attempts, base))


def remove_documents(
    rows: DataFrame,
    connect: Callable[[], DocumentClient],
    keys: Sequence[str],
    chunk_size: int = 500,
    attempts: int = ATTEMPTS,
    base: float = WAIT_BASE,
) -> None:
    """Remove the document of every given key; keys without a document do no harm."""
    rows.select(*keys).foreachPartition(
        _sender(connect, lambda client, found: client.delete_many(found), chunk_size, attempts, base)
    )


def _sender(connect, call, chunk_size: int, attempts: int, base: float) -> Callable[[Iterator[Row]], None]:
    def send(rows: Iterator[Row]) -> None:
        """One client per task; after a failure it is closed and the next attempt connects again."""
        clients: list[DocumentClient] = []

        def close() -> None:
            while clients:
                clients.pop().close()

        def attempt(batch: list[dict]) -> None:
            if not clients:
                clients.append(connect())
            try:
                call(clients[0], batch)
            except Exception:
                close()
                raise

        try:
            for chunk in _chunks(rows, chunk_size):
                found = [row.asDict(recursive=True) for row in chunk]
                retrying(lambda batch=found: attempt(batch), attempts, base)
        finally:
            close()

    return send
