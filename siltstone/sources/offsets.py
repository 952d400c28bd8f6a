"""Offsets of the two sides of a stream as plain dictionaries, which Spark keeps as JSON."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class Offset:
    """``archive``: the last hour that was read, in epoch seconds; ``tail``: the next offset of each topic and partition."""

    archive: int | None = None
    tail: dict[tuple[str, int], int] | None = field(default=None)

    def to_dict(self) -> dict:
        """The stored form (fixed names and nesting of the stream's checkpoints)."""
        archive = None if self.archive is None else {"offset": self.archive, "json": str(self.archive)}
        tail = None if self.tail is None else {"serializedKafkaOffset": {f"{t}-{p}": n for (t, p), n in sorted(self.tail.items())}}
        return {"version": 1, "archiveOffset": archive, "kafkaOffset": tail}


def from_dict(stored: dict) -> Offset:
    if stored.get("version") != 1:
        raise ValueError(f"offset version {stored.get('version')} isn't known")
    archive, tail = stored.get("archiveOffset"), stored.get("kafkaOffset")
    parts = None
    if tail is not None:
        parts = {}
        for key, n in tail["serializedKafkaOffset"].items():
            topic, dash, partition = (key or "").rpartition("-")
            if not dash or not partition.isdigit() or n is None:
                raise ValueError(f"tail offset {key!r}: {n!r}")
            parts[topic, int(partition)] = int(n)
    return Offset(None if archive is None else int(archive["offset"]), parts)
