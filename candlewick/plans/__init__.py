"""Models, checks and reports over the tick log. Pure DataFrame functions unless the name says it writes."""
