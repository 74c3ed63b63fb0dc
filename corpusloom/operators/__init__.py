"""Row predicates, de-duplication, decontamination, segments, splits and statistics."""
