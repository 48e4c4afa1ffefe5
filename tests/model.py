"""What delivery tracking means, stated on the list of all earlier events.

Nothing is kept but the list. Every answer is worked out from it by definition,
which is slow and leaves nothing to get out of step.
"""

from __future__ import annotations

from itertools import takewhile

TOP = 2**63 - 1


class Tracker:
    """Answers to the events of any number of partitions, one after another."""

    def __init__(self):
        # (kind, partition, epoch, offset), oldest first.
        self.history = []

    # -- what the history says -------------------------------------------------

    def assignments(self):
        return sum(e[0] == "assign" for e in self.history)

    def epoch_of(self, tp):
        """Number of the assignment a partition is under, if it is under one."""
        last = [e for e in self.history if e[1] == tp and e[0] in ("assign", "revoke")][-1:]
        return last[0][2] if last and last[0][0] == "assign" else None

    def offsets(self, tp, kind):
        """Offsets of the events of a kind in the partition's present assignment."""
        epoch = self.epoch_of(tp)
        return [o for k, p, e, o in self.history if (k, p, e) == (kind, tp, epoch)]

    def finished(self, tp):
        """The delivered offsets, in order, before the first that has not succeeded."""
        done = set(self.offsets(tp, "success"))
        return list(takewhile(done.__contains__, sorted(self.offsets(tp, "delivery"))))

    def safe(self, tp):
        """One past the last finished offset that has a successor."""
        return max((o + 1 for o in self.finished(tp) if o != TOP), default=None)

    # -- events ----------------------------------------------------------------

    def assign(self, tp):
        epoch = 1 + self.assignments()
        self.history.append(("assign", tp, epoch, None))
        return epoch

    def revoke(self, tp):
        epoch = self.epoch_of(tp)
        self.history.append(("revoke", tp, epoch, None))
        return epoch

    def deliver(self, tp, epoch, offset):
        delivered = self.offsets(tp, "delivery")
        answers = {
            "unassigned": self.epoch_of(tp) is None,
            "epoch_mismatch": self.epoch_of(tp) != epoch,
            "duplicate": offset in set(delivered) - set(self.finished(tp)),
            "non_monotonic": offset <= max(delivered, default=offset - 1),
        }
        for answer, holds in answers.items():
            if holds:
                return answer
        self.history.append(("delivery", tp, epoch, offset))
        return "ok"

    def succeed(self, tp, epoch, offset):
        """(effect, safe offset stored by this completion or None)"""
        if epoch is None or self.epoch_of(tp) != epoch:
            return "stale", None
        before = self.safe(tp)
        if before is not None and offset < before:
            return "unchanged", None
        if offset not in set(self.offsets(tp, "delivery")) - set(self.finished(tp)):
            return "unknown_delivery", None
        if offset in self.offsets(tp, "success"):
            return "unchanged", None
        self.history.append(("success", tp, epoch, offset))
        if TOP in self.finished(tp):
            return "offset_overflow", None
        after = self.safe(tp)
        return ("unchanged", None) if after == before else ("store_next", after)

    def snapshot(self):
        """Safe offsets of the present assignments that have one."""
        assigned = {e[1] for e in self.history if e[0] == "assign"}
        live = {tp: self.epoch_of(tp) for tp in assigned}
        return {(*tp, epoch): self.safe(tp) for tp, epoch in live.items() if epoch is not None and self.safe(tp) is not None}
