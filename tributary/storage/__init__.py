"""Tables that change as a whole: an ordered commit log, published snapshots and append logs over it."""
