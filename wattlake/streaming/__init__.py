"""Event-stream jobs (S1-S7): every transform is a plain DataFrame function
that runs unchanged on a streaming or a batch frame."""
