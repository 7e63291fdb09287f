from abacist.operators import matrix, ordering, records, sprints, tickets, tokens, usage

__all__ = ["matrix", "ordering", "records", "sprints", "tickets", "tokens", "usage"]
