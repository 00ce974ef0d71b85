"""Operators that a pipeline for training data needs beside the reference's own."""
