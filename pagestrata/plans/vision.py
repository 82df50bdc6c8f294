"""Hook for a vision model: requests under a rate limit with retries, answers cleaned, rules where it fails. The client is given."""

from __future__ import annotations

import random
import threading
import time
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.labels import normalise_label

THROTTLE_CODES = {"ThrottlingException", "ProvisionedThroughputExceededException"}
THROTTLE_STATUS = {429, 500}


class Limiter:
    """At most qps requests a second, 0.1 at least; unused time is not saved up beyond one request."""

    def __init__(self, qps: float, clock: Callable[[], float] = time.monotonic, sleep: Callable[[float], None] = time.sleep):
        self.gap, self.clock, self.sleep = 1 / max(qps, 0.1), clock, sleep
        self.lock, self.next = threading.Lock(), clock()

    def acquire(self) -> None:
        with self.lock:
            now = self.clock()
            start = max(now, self.next)
            self.next = start + self.gap
        if start > now:
            self.sleep(start - now)


def is_throttled(error: Exception) -> bool:
    """Whether an error asks to come back later: by its code, or by its HTTP status."""
    told = getattr(error, "response", None)
    if not isinstance(told, dict):
        return False
    return told.get("Error", {}).get("Code") in THROTTLE_CODES or told.get("ResponseMetadata", {}).get("HTTPStatusCode") in THROTTLE_STATUS


def delay(attempt: int, base: float = 0.4, cap: float = 8.0, draw: Callable[[float, float], float] = random.uniform) -> float:
    return min(cap, base * 2**attempt) * draw(0.5, 1.5)


def ask(send: Callable[[bytes], str], image: bytes, limiter: Limiter, retries: int = 6, counts: dict | None = None, sleep: Callable[[float], None] = time.sleep) -> str | None:
    """The model's answer; null when it fails for another reason than its rate, or too often."""
    counts = counts if counts is not None else {}
    for attempt in range(retries + 1):
        limiter.acquire()
        try:
            return send(image)
        except Exception as error:  # noqa: BLE001  # whatever a client raises
            if not is_throttled(error):
                return None
            counts["throttles"] = counts.get("throttles", 0) + 1
            if attempt < retries:
                counts["retries"] = counts.get("retries", 0) + 1
                sleep(delay(attempt))
    return None


def vision_classifier(client: Callable[[], Callable[[bytes], str]], fallback: Callable[[DataFrame], DataFrame], qps: float = 2.0, retries: int = 6) -> Callable[[DataFrame], DataFrame]:
    """A classifier of pages (doc_id, page, image, ...) -> doc_id, page, label.

    client makes, once a task, the function that sends an image. The rate is shared out over the tasks that run at once. Answers that are no class, and failed requests,
    go to the fallback, which sees those pages only.
    """

    def classify(pages: DataFrame) -> DataFrame:
        share = qps / max(1, pages.sparkSession.sparkContext.defaultParallelism)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            send, limiter = client(), Limiter(share)
            for batch in batches:
                answers = [ask(send, image, limiter, retries) for image in batch.column("image").to_pylist()]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("page"), pa.array(answers, pa.string())], names=["doc_id", "page", "answer"])

        asked = pages.select("doc_id", "page", "image").mapInArrow(run, f"doc_id {pages.schema['doc_id'].dataType.simpleString()}, page int, answer string")
        known = asked.select("doc_id", "page", normalise_label(F.coalesce("answer", F.lit(""))).alias("label"), "answer").cache()  # a request is sent once
        sure = known.where("label <> 'unknown' OR lower(trim(answer)) = 'unknown'").select("doc_id", "page", "label")
        rest = pages.join(sure, ["doc_id", "page"], "left_anti")
        return sure.unionByName(fallback(rest).select("doc_id", "page", "label"))

    return classify


def fit_image(encode: Callable[[float], bytes], limit: int, scale: float = 1.0, floor: float = 0.2, tries: int = 10) -> bytes:
    """Encoded image of at most limit bytes: the scale moves half-way to what the size asks for, down to floor; the last attempt if none fits."""
    out = encode(scale)
    for _ in range(tries):
        if len(out) <= limit or scale <= floor:
            break
        wanted = max(floor, (scale + scale * (limit / len(out)) ** 0.5) / 2)
        scale = wanted if scale - wanted >= 0.01 else max(floor, scale * 0.95)
        out = encode(scale)
    return out


def compress(encode: Callable[[int], bytes], limit: int = 500_000, quality: int = 85, least: int = 30, step: int = 10) -> bytes:
    """Encoded image at falling quality until it has at most limit bytes or quality reaches the least."""
    out = encode(quality)
    while len(out) > limit and quality > least:
        quality -= step
        out = encode(quality)
    return out
