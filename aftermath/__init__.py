"""Disaster recovery-cost analytics as DataFrame-to-DataFrame functions on Spark."""
