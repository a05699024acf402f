"""Summarise job and stage durations from a Spark event log folder (zstd or plain).

usage: python scripts/eventlog_stages.py <event-log-dir>
"""

import glob
import io
import json
import sys

import zstandard


def lines(path):
    raw = open(path, "rb").read()
    if path.endswith(".zstd") or raw[:4] == b"\x28\xb5\x2f\xfd":
        raw = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(raw)).read()
    return raw.decode().splitlines()


def main(folder):
    stages, jobs = {}, {}
    for f in sorted(glob.glob(f"{folder}/**/*", recursive=True)):
        if "." in f.rsplit("/", 1)[-1] and not f.endswith(".zstd"):
            continue
        try:
            ls = lines(f)
        except (IsADirectoryError, UnicodeDecodeError):
            continue
        for line in ls:
            e = json.loads(line)
            ev = e["Event"]
            if ev == "SparkListenerStageCompleted":
                si = e["Stage Info"]
                stages[si["Stage ID"]] = (si["Stage Name"][:40], si["Number of Tasks"], si.get("Completion Time", 0) - si.get("Submission Time", 0))
            elif ev == "SparkListenerJobStart":
                jobs[e["Job ID"]] = [e["Submission Time"], e["Stage IDs"], (e.get("Properties") or {}).get("spark.job.description")]
            elif ev == "SparkListenerJobEnd":
                jobs[e["Job ID"]][0] = e["Completion Time"] - jobs[e["Job ID"]][0]
    for k in sorted(jobs):
        ms, ids, d = jobs[k]
        print(f"job {k:3d} {ms:6d} ms  {d}  stages={[(i, stages.get(i, ('skipped', 0, 0))[1:]) for i in ids]}")


if __name__ == "__main__":
    main(sys.argv[1])
