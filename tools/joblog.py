"""Summarise a Spark event log: wall time per job with its call site.

    python tools/joblog.py <event-log-file> [top_n]
"""

from __future__ import annotations

import glob
import io
import json
import os
import sys


def lines(path: str):
    if os.path.isdir(path):
        path = sorted(glob.glob(os.path.join(path, "**", "events_*"), recursive=True))[0]
    if path.endswith(".zstd"):
        import zstandard
        with open(path, "rb") as fh:
            yield from io.TextIOWrapper(zstandard.ZstdDecompressor().stream_reader(fh), encoding="utf-8")
    else:
        yield from open(path)


def main() -> None:
    path = sys.argv[1]
    top = int(sys.argv[2]) if len(sys.argv) > 2 and sys.argv[2].isdigit() else 40
    jobs: dict[int, dict] = {}
    stages: dict[int, dict] = {}
    tasks: dict[int, list] = {}
    sql: dict[str, str] = {}
    for line in lines(path):
        e = json.loads(line)
        ev = e.get("Event")
        if ev == "SparkListenerJobStart":
            props = e.get("Properties", {})
            eid = props.get("spark.sql.execution.id", "")
            jobs[e["Job ID"]] = {"start": e["Submission Time"], "eid": eid,
                                 "desc": props.get("callSite.short") or props.get("spark.job.description") or "",
                                 "stages": e.get("Stage IDs", [])}
        elif ev == "org.apache.spark.sql.execution.ui.SparkListenerSQLExecutionStart":
            plan = e.get("physicalPlanDescription", "")
            head = " ".join(x.strip() for x in plan.splitlines()[1:4])
            sql[str(e["executionId"])] = (e.get("description", "") + " | " + head)[:150]
        elif ev == "SparkListenerJobEnd":
            jobs[e["Job ID"]]["end"] = e["Completion Time"]
        elif ev == "SparkListenerTaskEnd":
            ti = e["Task Info"]
            recs = (e.get("Task Metrics") or {}).get("Shuffle Read Metrics", {})
            nrec = recs.get("Total Records Read", 0) + (e.get("Task Metrics") or {}).get(
                "Input Metrics", {}).get("Records Read", 0)
            tasks.setdefault(e["Stage ID"], []).append((ti["Finish Time"] - ti["Launch Time"], nrec))
        elif ev == "SparkListenerStageCompleted":
            si = e["Stage Info"]
            stages[si["Stage ID"]] = {"tasks": si["Number of Tasks"],
                                      "dur": si.get("Completion Time", 0) - si.get("Submission Time", 0),
                                      "name": si["Stage Name"]}
    rows = []
    for jid, j in jobs.items():
        d = (j.get("end", j["start"]) - j["start"]) / 1000
        st = [stages[s] for s in j["stages"] if s in stages]
        desc = j["desc"] or sql.get(j["eid"], "?")
        rows.append((d, jid, desc, [(s["tasks"], round(s["dur"] / 1000, 2)) for s in st]))
    total = sum(r[0] for r in rows)
    print(f"{len(rows)} jobs, {total:.2f}s summed job time")
    by: dict[str, list] = {}
    for d, jid, desc, st in rows:
        key = desc.split(" | ")[0] if jobs[jid]["desc"] else "?"
        by.setdefault(key, []).append(d)
    for k, v in sorted(by.items(), key=lambda kv: -sum(kv[1])):
        print(f"  {sum(v):7.2f}s {len(v):4d} jobs  {k[:90]}")
    if "--tasks" in sys.argv:
        print("stages with >1 task: max/median task ms and records (skew check)")
        for sid, ts in sorted(tasks.items()):
            if len(ts) < 2:
                continue
            durs = sorted(t for t, _ in ts)
            recs = sorted(r for _, r in ts)
            med_d, med_r = durs[len(durs) // 2], recs[len(recs) // 2]
            flag = "  <-- skew?" if recs[-1] > 4 * max(med_r, 1) and recs[-1] > 50000 else ""
            print(f"  stage {sid:4d} {len(ts):4d} tasks  ms max {durs[-1]:6d} med {med_d:6d}  "
                  f"records max {recs[-1]:9d} med {med_r:9d}{flag}")
    for d, jid, desc, st in sorted(rows, reverse=True)[:top]:
        print(f"{d:7.2f}s job {jid:4d} {st[:3]} {desc[:150]}")


if __name__ == "__main__":
    main()
