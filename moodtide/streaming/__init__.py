"""Resumable work: each run takes up what earlier runs have not done."""
