"""The driver's queries, their SQL twins and the observation view both read."""
