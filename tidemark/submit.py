"""How a job is submitted: the command, its memory, and the optional lineage listener."""

from __future__ import annotations

import os
import socket
import sys
from urllib.parse import urlparse

# Heap of a job's driver in MB (the streams run for ever in little), and of any other.
HEAP_MB = {"streams": 512, "gold": 1024}
OTHER_HEAP_MB = 768


def command(job: str, script: str, master: str = "local[2]", conf: dict[str, str] | None = None) -> list[str]:
    """The spark-submit call of a job."""
    settings = [x for k, v in sorted((conf or {}).items()) for x in ("--conf", f"{k}={v}")]
    return ["spark-submit", "--master", master, "--driver-memory", f"{HEAP_MB.get(job, OTHER_HEAP_MB)}m", *settings, script]


def reachable(url: str, timeout: float = 2.0) -> bool:
    at = urlparse(url)
    try:
        socket.create_connection((at.hostname, at.port or 80), timeout).close()
        return True
    except OSError:
        return False


def lineage_settings(url: str | None, namespace: str = "tidemark", up=reachable) -> dict[str, str]:
    """Settings of the OpenLineage listener; none without an address that answers, so a job never waits for it."""
    if not url or not up(url):
        return {}
    return {
        "spark.extraListeners": "io.openlineage.spark.agent.OpenLineageSparkListener", "spark.openlineage.namespace": namespace,
        "spark.openlineage.transport.type": "http", "spark.openlineage.transport.url": url,
    }


def main(argv: list[str]) -> None:
    """python -m tidemark.submit JOB SCRIPT: replaces this process, so that signals and the exit code are the job's."""
    call = command(*argv[:2], conf=lineage_settings(os.environ.get("OPENLINEAGE_URL")))
    os.execvp(call[0], call)


if __name__ == "__main__":
    main(sys.argv[1:])
