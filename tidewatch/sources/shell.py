"""Fetching: the plain-Python edge of the engine. Transport is passed in, so
everything here can be tested without a network."""

from __future__ import annotations

import gzip
import json
import threading
import time
import urllib.error
import urllib.request
from collections.abc import Callable, Iterable, Iterator
from pathlib import Path

PAGE = 1000


class FetchError(RuntimeError):
    """A source gave an answer that is no data and no reason to try again."""


class RateLimiter:
    """Spaces calls of any number of threads by at least 1/cps seconds."""

    def __init__(self, cps: float, *, clock: Callable[[], float] = time.monotonic, sleep: Callable[[float], None] = time.sleep):
        self.gap, self.clock, self.sleep = 1 / cps, clock, sleep
        self.free_at, self.lock = float("-inf"), threading.Lock()

    def wait(self) -> None:
        with self.lock:
            now = self.clock()
            start = max(now, self.free_at)
            self.free_at = start + self.gap
        if start > now:
            self.sleep(start - now)


def http_get(url: str, headers: dict[str, str] | None = None, timeout: float = 30) -> tuple[int, str]:
    """(status, body); network errors are raised as OSError."""
    request = urllib.request.Request(url, headers=headers or {})
    try:
        with urllib.request.urlopen(request, timeout=timeout) as answer:
            return answer.status, answer.read().decode()
    except urllib.error.HTTPError as e:
        return e.code, e.read().decode(errors="replace")


def get_json(
    url: str, *, get: Callable[[str], tuple[int, str]] = http_get, tries: int = 6, sleep: Callable[[float], None] = time.sleep,
    before: Callable[[], None] = lambda: None, refused: float = 30.0,
):
    """The parsed answer. Network errors, 5xx and answers that are no JSON are
    tried again with growing pauses, 429 after `refused` seconds; other refusals
    raise at once. before is called ahead of every try, as a limiter needs."""
    why, pause = "", 0.0
    for attempt in range(tries):
        if attempt:
            sleep(pause)
        before()
        pause = min(2.0 ** (attempt + 1), 30)
        try:
            status, body = get(url)
        except OSError as e:
            why = str(e)
            continue
        if status == 429 or status >= 500:
            why = f"status {status}"
            pause = refused if status == 429 else pause
            continue
        if status >= 400:
            raise FetchError(f"{url}: status {status}")
        try:
            return json.loads(body)
        except ValueError:
            why = "no JSON"
    raise FetchError(f"{url}: {why}")


def rpc(call: Callable[[], dict], *, tries: int = 8, sleep: Callable[[float], None] = time.sleep):
    """The result of a status/message/result answer: no records is an empty
    list, a rate limit is tried again, anything else raises."""
    for attempt in range(tries):
        if attempt:
            sleep(min(2.0**attempt, 30))
        answer = call()
        result, message = answer.get("result"), str(answer.get("message", ""))
        if str(answer.get("status", "1")) == "1":
            return result
        if message.startswith("No ") and message.rstrip(".").endswith("found"):
            return []
        if "rate limit" not in f"{message} {result}".lower():
            raise FetchError(f"{message}: {result}")
    raise FetchError("rate limited for too long")


def complete_blocks(
    fetch: Callable[[int, int, int], list[dict]], start: int, end: int, *, page_size: int = PAGE
) -> Iterator[tuple[list[dict], int]]:
    """(records, next block) batches of whole blocks. fetch(first, last, page)
    answers at most page_size records, and any answer may stop short. So of an
    answer that reaches beyond the block asked from, the last block is never
    taken: the next question starts with it. What is then answered with that
    block alone is the block, paged through if it fills the page. An empty answer
    is believed when it comes twice; the range then ends with an empty batch."""
    asked, doubted = start, False
    while asked <= end:
        answer = fetch(asked, end, 1)
        if answer:
            doubted = False
            newest = int(answer[-1]["blockNumber"])
            if newest > asked:
                yield [r for r in answer if int(r["blockNumber"]) != newest], newest
                asked = newest
            else:
                yield [*answer, *_further_pages(fetch, asked, page_size if len(answer) == page_size else 0)], asked + 1
                asked += 1
        elif doubted:
            yield [], end + 1
            return
        else:
            doubted = True


def _further_pages(fetch: Callable[[int, int, int], list[dict]], block: int, full: int) -> Iterator[dict]:
    """The records of a block from its second page on, until a page is not full."""
    page, size = 1, full
    while full and size == full:
        page += 1
        more = fetch(block, block, page)
        size = len(more)
        yield from more


def all_pages(fetch: Callable[[int], list], n: int) -> list:
    """Pages until n items or an empty page; n at most."""
    out: list = []
    page = 1
    while len(out) < n:
        got = fetch(page)
        if not got:
            break
        out += got
        page += 1
    return out[:n]


class Checkpoint:
    """An append-only gzip JSON-lines file and how much of it counts. Lines after
    the count are from a broken run and are cut off."""

    def __init__(self, folder: Path, name: str):
        self.lines, self.state = folder / f"{name}.jsonl.gz", folder / f"{name}.state.json"
        folder.mkdir(parents=True, exist_ok=True)

    def load(self) -> dict:
        return json.loads(self.state.read_text()) if self.state.exists() else {"rows": 0, "next": None}

    def trim(self) -> int:
        rows = self.load()["rows"]
        held: list[str] = []
        if self.lines.exists():
            try:
                with gzip.open(self.lines, "rt") as f:
                    for line in f:
                        if len(held) == rows:
                            break
                        held.append(line)
            except EOFError:
                pass
        if len(held) < rows:
            raise FetchError(f"{self.lines} holds {len(held)} of {rows} rows")
        with gzip.open(self.lines, "wt") as f:
            f.writelines(held)
        return rows

    def append(self, records: Iterable[dict], cursor: int) -> None:
        records = list(records)
        with gzip.open(self.lines, "at") as f:
            f.writelines(json.dumps(r) + "\n" for r in records)
        state = {"rows": self.load()["rows"] + len(records), "next": cursor}
        part = self.state.with_suffix(".part")
        part.write_text(json.dumps(state))
        part.replace(self.state)


    def newest_block(self) -> int | None:
        """The block of the last line that counts."""
        rows, last = self.load()["rows"], None
        if rows:
            with gzip.open(self.lines, "rt") as f:
                for _, last in zip(range(rows), f):
                    pass
        return None if last is None else int(json.loads(last)["blockNumber"])


def numbered(records: Iterable[dict]) -> list[dict]:
    """Transfer records of whole blocks, in order, with the fields that are kept
    and txSeq, the place within their transaction."""
    from tidewatch.sources.transfers_json import FIELDS

    met: dict[str, int] = {}
    out = []
    for r in records:
        met[r["hash"]] = met.get(r["hash"], -1) + 1
        out.append({f: r.get(f) for f in FIELDS} | {"txSeq": met[r["hash"]]})
    return out


def pull(
    fetch: Callable[[int, int, int], list[dict]], checkpoint: Checkpoint, start: int, end: int, *, page_size: int = PAGE,
    recheck: bool = False, shape: Callable[[list[dict]], list[dict]] = list,
) -> int:
    """Resumes at the checkpoint and appends whole blocks; returns rows held.
    recheck: go on after the last block that is stored, whatever the checkpoint
    says, to fill a range that was once taken for finished. shape: what is done
    to a batch, as numbered."""
    checkpoint.trim()
    at = checkpoint.load()["next"] or start
    if recheck:
        stored = checkpoint.newest_block()
        at = start if stored is None else stored + 1
    for records, cursor in complete_blocks(fetch, at, end, page_size=page_size):
        checkpoint.append(shape(records), cursor)
    return checkpoint.load()["rows"]


def cached_fetch(wanted: Iterable[str], folder: Path, fetch: Callable[[str], object]) -> dict[str, object]:
    """Fetches what is not in the folder; failures are collected, not raised."""
    folder.mkdir(parents=True, exist_ok=True)
    out: dict = {"fetched": 0, "cached": 0, "failed": {}}
    for name in wanted:
        path = folder / f"{name}.json"
        if path.exists():
            out["cached"] += 1
            continue
        try:
            path.write_text(json.dumps(fetch(name)))
            out["fetched"] += 1
        except Exception as e:  # noqa: BLE001
            out["failed"][name] = str(e)
    return out


def retried(job: Callable[[], object], *, more: int = 2, delay: float = 60, sleep: Callable[[float], None] = time.sleep):
    """The job's result; a failure is tried again `more` times, each after twice
    the pause before, and raised after the last."""
    for attempt in range(more + 1):
        try:
            return job()
        except Exception:  # noqa: BLE001
            if attempt == more:
                raise
            sleep(delay * 2**attempt)


def once(path: Path, make: Callable[[], object]):
    """What the file holds, made and written first where there is none."""
    if not path.exists():
        path.parent.mkdir(parents=True, exist_ok=True)
        part = path.with_suffix(".part")
        part.write_text(json.dumps(make(), indent=2))
        part.replace(path)
    return json.loads(path.read_text())


def statements(sql: str) -> list[str]:
    """A script's statements, without comment lines."""
    lines = [x for x in sql.splitlines() if not x.lstrip().startswith("--")]
    return [s.strip() for s in "\n".join(lines).split(";\n") if s.strip().rstrip(";")]
