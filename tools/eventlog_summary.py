"""Summarise a Spark event log: one line per job with duration and call site.

usage: python tools/eventlog_summary.py <event-log-file>
"""

import json
import sys


def main(path):
    jobs, stages = {}, {}
    if path.endswith(".zstd"):
        import io

        import zstandard
        raw = zstandard.ZstdDecompressor().stream_reader(open(path, "rb"))
        f = io.TextIOWrapper(raw, encoding="utf-8")
    else:
        f = open(path)
    with f:
        for line in f:
            e = json.loads(line)
            ev = e.get("Event")
            if ev == "SparkListenerJobStart":
                props = e.get("Properties", {})
                jobs[e["Job ID"]] = {"start": e["Submission Time"],
                                     "site": props.get("callSite.short", "?"),
                                     "stages": e.get("Stage IDs", [])}
            elif ev == "SparkListenerJobEnd":
                jobs[e["Job ID"]]["end"] = e["Completion Time"]
            elif ev == "SparkListenerStageCompleted":
                info = e["Stage Info"]
                stages[info["Stage ID"]] = (info.get("Completion Time", 0) - info.get("Submission Time", 0),
                                            info["Number of Tasks"], info["Stage Name"][:60])
    total = 0
    for jid, j in sorted(jobs.items()):
        d = j.get("end", j["start"]) - j["start"]
        total += d
        st = " ".join(f"s{s}:{stages[s][0]}ms/{stages[s][1]}t" for s in j["stages"] if s in stages)
        print(f"job {jid:4d} {d:6d}ms  {j['site'][:70]:70s} {st}")
    print("sum of job time ms:", total)


def find_log(d):
    import glob
    return sorted(glob.glob(f"{d}/**/events_*", recursive=True) + glob.glob(f"{d}/local-*"))[0]


if __name__ == "__main__":
    import os
    main(find_log(sys.argv[1]) if os.path.isdir(sys.argv[1]) else sys.argv[1])
