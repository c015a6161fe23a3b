"""Summarise a Spark event log (zstd or plain): jobs and stage time per job group."""
import glob
import io
import json
import sys
from collections import defaultdict


def lines(path):
    if path.endswith(".zstd"):
        import zstandard
        with open(path, "rb") as f:
            yield from io.TextIOWrapper(zstandard.ZstdDecompressor().stream_reader(f), encoding="utf-8")
    else:
        yield from open(path, encoding="utf-8")


def main(folder):
    jobs, stages, stage_group = {}, {}, {}
    for f in sorted(glob.glob(f"{folder}/**/events_*", recursive=True)):
        for line in lines(f):
            e = json.loads(line)
            t = e["Event"]
            if t == "SparkListenerJobStart":
                g = e.get("Properties", {}).get("spark.jobGroup.id")
                jobs[e["Job ID"]] = [e["Submission Time"], None, g]
                for s in e["Stage IDs"]:
                    stage_group[s] = g
            elif t == "SparkListenerJobEnd":
                jobs[e["Job ID"]][1] = e["Completion Time"]
            elif t == "SparkListenerStageCompleted":
                si = e["Stage Info"]
                stages[si["Stage ID"]] = (si["Stage Name"][:60], si["Number of Tasks"],
                                          si.get("Completion Time", 0) - si.get("Submission Time", 0))
    agg = defaultdict(lambda: [0, 0, 0, 0])
    for s, c, g in jobs.values():
        agg[g][0] += 1
        agg[g][1] += (c - s) if c else 0
    for sid, (name, ntask, ms) in stages.items():
        g = stage_group.get(sid)
        agg[g][2] += 1
        agg[g][3] += ms
    for g, (nj, jms, ns, sms) in agg.items():
        print(f"{g}: jobs={nj} job_ms={jms} stages_run={ns} stage_ms={sms}")
    for sid, v in sorted(stages.items(), key=lambda x: -x[1][2])[:15]:
        print(sid, stage_group.get(sid), v)


if __name__ == "__main__":
    main(sys.argv[1])
