"""Compiled loops of the tree searches: the same trees and sums as NumPy gives, at a fraction of its time.

The source below is compiled once an application by the compiler that Spark brings for its own
generated code, and shipped as a jar; a task is one call on the table that is broadcast to the
executors' JVMs.  Sums are whole numbers, and cuts are compared by the same operations in the same
order as in :mod:`panelwright.operators.trees`, so trees are equal bit for bit.  Where the session
gives no access to its JVM, NumPy does the work.
"""

from __future__ import annotations

import os
import tempfile
import threading
import warnings
import zipfile

import numpy as np
from py4j.protocol import Py4JError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession

NAME = "panelwright.kernels.TreeTasks"

SOURCE = r"""
package panelwright.kernels;

import java.nio.ByteBuffer;
import java.nio.ByteOrder;

/** One task of a search on the broadcast table: some trees of forests that differ in limits only, or some rounds of a boosting. */
public class TreeTasks implements org.apache.spark.sql.api.java.UDF1, java.io.Serializable {
    private final org.apache.spark.broadcast.Broadcast table;
    private final byte[] tasks;

    public TreeTasks(org.apache.spark.broadcast.Broadcast table, byte[] tasks) {
        this.table = table;
        this.tasks = tasks;
    }

    /** What the task of each number gives. */
    public static org.apache.spark.sql.Column of(org.apache.spark.broadcast.Broadcast table, byte[] tasks, org.apache.spark.sql.Column number) {
        org.apache.spark.sql.api.java.UDF1 run = new TreeTasks(table, tasks);
        return org.apache.spark.sql.functions.udf(run, org.apache.spark.sql.types.DataTypes.BinaryType).apply(new org.apache.spark.sql.Column[] {number});
    }

    /** The scores of rows, from the array of their values, by a model that :func:`model_bytes` wrote. */
    public static org.apache.spark.sql.Column scores(org.apache.spark.broadcast.Broadcast model, org.apache.spark.sql.Column values) {
        org.apache.spark.sql.api.java.UDF1 run = new Scores(model);
        return org.apache.spark.sql.functions.udf(run, org.apache.spark.sql.types.DataTypes.DoubleType).apply(new org.apache.spark.sql.Column[] {values});
    }

    private static ByteBuffer open(byte[] x) {
        return ByteBuffer.wrap(x).order(ByteOrder.LITTLE_ENDIAN);
    }

    /** tasks: how many, where each begins (in words), and their words. */
    public Object call(Object index) {
        ByteBuffer all = open(tasks);
        int i = ((Number) index).intValue();
        all.position((int) (8 * all.getLong(8 * (1 + i))));
        ByteBuffer task = ((ByteBuffer) all.slice()).order(ByteOrder.LITTLE_ENDIAN);
        Rows rows = new Rows(open((byte[]) table.value()), task);
        return task.getLong(0) == 0 ? new Forest(rows, task).run() : new Boost(rows, task).run();
    }

    static long mix(long h) {
        h += 0x9E3779B97F4A7C15L;
        h = (h ^ (h >>> 30)) * 0xBF58476D1CE4E5B9L;
        h = (h ^ (h >>> 27)) * 0x94D049BB133111EBL;
        return h ^ (h >>> 31);
    }

    static double most(double a) {
        return a > 1e-300 ? a : 1e-300;
    }

    /** The table (n, p, row hashes, outcomes, folds, bins) as a task reads it: rows of other folds, and rows held out. */
    static class Rows {
        int n, p, held;
        long[] id;
        double[] y, heldY;
        byte[] bins, heldBins;
        int[] count, first;

        Rows(ByteBuffer in, ByteBuffer task) {
            long fold = task.getLong(8);
            int all = (int) in.getLong();
            p = (int) in.getLong();
            int atY = 16 + 8 * all, atFold = atY + 8 * all, atBins = atFold + 4 * all;
            for (int i = 0; i < all; i++) {
                if (in.getInt(atFold + 4 * i) == fold) held++;
            }
            n = all - held;
            id = new long[n];
            y = new double[n];
            heldY = new double[held];
            bins = new byte[n * p];
            heldBins = new byte[held * p];
            byte[] fill = new byte[p];
            for (int j = 0; j < p; j++) fill[j] = (byte) task.getLong(16 + 8 * j);
            count = new int[p];
            int own = 0, out = 0;
            byte[] row = new byte[p];
            for (int i = 0; i < all; i++) {
                in.position(atBins + i * p);
                in.get(row);
                boolean mine = in.getInt(atFold + 4 * i) != fold;
                for (int j = 0; j < p; j++) {
                    if (row[j] == -1) row[j] = fill[j];
                    if ((row[j] & 255) >= count[j]) count[j] = (row[j] & 255) + 1;
                }
                if (mine) {
                    id[own] = in.getLong(16 + 8 * i);
                    y[own] = in.getDouble(atY + 8 * i);
                    System.arraycopy(row, 0, bins, own * p, p);
                    own++;
                } else {
                    heldY[out] = in.getDouble(atY + 8 * i);
                    System.arraycopy(row, 0, heldBins, out * p, p);
                    out++;
                }
            }
            first = new int[p + 1];
            for (int j = 0; j < p; j++) first[j + 1] = first[j] + count[j];
            task.position(16 + 8 * p);
        }
    }

    /** The best cuts of a node, one for each least leaf; those rise. */
    static class Best {
        final double[] least, gain;
        final long[] g, h;
        final int[] feature, bin;
        final double leastGain, l2;
        double base;
        long gt, ht;
        int from, to;
        static final double[] PART = new double[1024];

        static {
            for (int i = 1; i < PART.length; i++) PART[i] = 1.0 / i;
        }

        Best(double[] least, double leastGain, double l2) {
            this.least = least;
            this.leastGain = leastGain;
            this.l2 = l2;
            gain = new double[least.length];
            g = new long[least.length];
            h = new long[least.length];
            feature = new int[least.length];
            bin = new int[least.length];
        }

        void begin(long gt, long ht, int from, int to) {
            this.gt = gt;
            this.ht = ht;
            this.from = from;
            this.to = to;
            base = (double) gt * (double) gt / most(ht + l2);
            for (int i = from; i <= to; i++) gain[i] = 0;
        }

        /** One candidate; of equal gains the first stays. */
        void weigh(long gl, long hl, int j, int b) {
            long hr = ht - hl, gr = gt - gl;
            if (hl < least[from] || hr < least[from]) return;
            if (ht < PART.length && l2 == 0) {  // what is clearly below the best of all that it could replace needs no division
                int last = from;
                while (last < to && hl >= least[last + 1] && hr >= least[last + 1]) last++;
                if (((double) gl * (double) gl * PART[(int) hl] + (double) gr * (double) gr * PART[(int) hr]) * (1 + 1e-12) < base + gain[last]) return;
            }
            double left = (double) gl * (double) gl / most(hl + l2), right = (double) gr * (double) gr / most(hr + l2);
            double now = left + right - base;
            if (!(now > leastGain * (left + right))) return;
            for (int i = from; i <= to && hl >= least[i] && hr >= least[i]; i++) {
                if (now > gain[i]) {
                    gain[i] = now;
                    g[i] = gl;
                    h[i] = hl;
                    feature[i] = j;
                    bin[i] = b;
                }
            }
        }

        /** All bins of a feature, with the sums (g, h) of its bins from ``at``; ``clear``: leaves zeros. */
        void scan(long[] sums, int at, int count, int j, boolean clear) {
            long gl = 0, hl = 0;
            for (int b = 0; b < count; b++) {
                int c = at + 2 * b;
                if (sums[c + 1] != 0) {
                    gl += sums[c];
                    hl += sums[c + 1];
                    weigh(gl, hl, j, b);
                    if (clear) {
                        sums[c] = 0;
                        sums[c + 1] = 0;
                    }
                }
            }
        }
    }

    /** Depth first; the rows of a node lie next to each other. A row is words: target by weight, then bytes: weight, bins. */
    static class Forest {
        static final int FEW = 128, FIELDS = 15;
        final Rows in;
        final int p, width, fits, words, heldWords, cells;
        final long[] seeds;
        final boolean bootstrap, emit, begins;
        final int[] limit, which, treesOf;
        final double[] whole;
        final double[] least, poisson;
        final double unit;
        final Best best;
        final long[] target, rows, spare, held, scratch;
        final double[][] total;
        final long[] hashes, draw;
        final int[] by, chosen;
        long[] stack = new long[64 * FIELDS];
        long[][] wholes = new long[64][];
        int top = 0;
        // the nodes of a tree, where they are asked for
        short[] feature = new short[0];
        byte[] cut = new byte[0];
        int[] child = new int[0];
        double[] value = new double[0];
        int nodes;

        Forest(Rows in, ByteBuffer task) {
            this.in = in;
            p = in.p;
            width = (int) task.getLong();
            bootstrap = task.getLong() != 0;
            emit = task.getLong() != 0;
            begins = task.getLong() != 0;
            unit = task.getDouble();
            double leastGain = task.getDouble();
            seeds = new long[(int) task.getLong()];
            for (int i = 0; i < seeds.length; i++) seeds[i] = task.getLong();
            poisson = new double[(int) task.getLong()];
            for (int i = 0; i < poisson.length; i++) poisson[i] = task.getDouble();
            least = new double[(int) task.getLong()];
            for (int i = 0; i < least.length; i++) least[i] = task.getDouble();
            fits = (int) task.getLong();
            limit = new int[fits];
            which = new int[fits];
            treesOf = new int[fits];
            whole = new double[fits];
            for (int d = 0; d < fits; d++) {
                limit[d] = (int) task.getLong();
                which[d] = (int) task.getLong();
                treesOf[d] = (int) task.getLong();
                whole[d] = task.getLong();
            }
            best = new Best(least, leastGain, 0.0);
            cells = in.first[p];
            words = 1 + (p + 8) / 8;
            heldWords = (p + 11) / 8;
            target = new long[in.n];
            for (int i = 0; i < in.n; i++) target[i] = (long) Math.rint(in.y[i] / unit);
            rows = new long[in.n * words];
            held = new long[in.held * heldWords];
            spare = new long[Math.max(rows.length, held.length) + Math.max(words, heldWords)];
            scratch = new long[512 * Math.max(2, p)];
            total = new double[emit ? 0 : fits][in.held];
            hashes = new long[p];
            draw = new long[p];
            by = new int[p];
            chosen = new int[p];
            for (int j = 0; j < p; j++) hashes[j] = mix(j + 1);
        }

        byte[] run() {
            byte[] draws = new byte[1 << 16];
            boolean[] mixed = new boolean[1 << 16];
            for (int i = 0; i < 1 << 16; i++) {
                draws[i] = (byte) draw(i / 65536.0);
                mixed[i] = draw((i + 1) / 65536.0) != draws[i];
            }
            java.util.ArrayList made = new java.util.ArrayList();
            int size = 0;
            for (int t = 0; t < seeds.length; t++) {
                long taking = 0;
                for (int d = 0; d < fits; d++) {
                    if (t < treesOf[d]) taking |= 1L << d;
                }
                if (taking == 0) break;
                tree(mix(seeds[t]), taking, draws, mixed);
                if (emit) {
                    ByteBuffer out = open(new byte[8 + 15 * nodes]);
                    out.putLong(nodes);
                    for (int i = 0; i < nodes; i++) out.putDouble(value[i]);
                    for (int i = 0; i < nodes; i++) out.putInt(child[i]);
                    for (int i = 0; i < nodes; i++) out.putShort(feature[i]);
                    for (int i = 0; i < nodes; i++) out.put(cut[i]);
                    made.add(out.array());
                    size += out.array().length;
                }
            }
            ByteBuffer out = open(new byte[emit ? size : 8 * fits * in.held]);
            for (int i = 0; i < made.size(); i++) out.put((byte[]) made.get(i));
            // These trees' part of the errors of every fit; the outcome is in the part of the first trees.
            for (int d = 0; d < total.length; d++) {
                for (int i = 0; i < in.held; i++) out.putDouble((begins ? in.heldY[i] : 0.0) - total[d][i] / whole[d]);
            }
            return out.array();
        }

        int draw(double share) {
            int w = 0;
            while (w < poisson.length && poisson[w] <= share) w++;
            return w;
        }

        void tree(long key, long taking, byte[] draws, boolean[] mixed) {
            int m = 0;
            long gt = 0, ht = 0;
            for (int i = 0; i < in.n; i++) {
                int w = 1;
                if (bootstrap) {
                    long u = mix(in.id[i] ^ key) >>> 11;
                    int high = (int) (u >>> 37);
                    w = mixed[high] ? draw(u / 9007199254740992.0) : (int) draws[high];
                    if (w == 0) continue;
                }
                int o = m * words;
                rows[o] = target[i] * w;
                long word = w;
                int k = 1, at = i * p;
                for (int j = 0; j < p; j++) {
                    int shift = ((j + 1) & 7) << 3;
                    if (shift == 0) {
                        rows[o + k] = word;
                        k++;
                        word = 0;
                    }
                    word |= (in.bins[at + j] & 255L) << shift;
                }
                rows[o + k] = word;
                gt += rows[o];
                ht += w;
                m++;
            }
            for (int i = 0; i < in.held; i++) {
                int o = i * heldWords, at = i * p, k = 0;
                long word = i;
                for (int j = 0; j < p; j++) {
                    int shift = ((j + 4) & 7) << 3;
                    if (shift == 0) {
                        held[o + k] = word;
                        k++;
                        word = 0;
                    }
                    word |= (in.heldBins[at + j] & 255L) << shift;
                }
                held[o + k] = word;
            }
            nodes = 0;
            if (emit) added(1);
            long[] whole = null;
            if (2 * width > p && m >= cells) {
                whole = new long[2 * cells];
                sumAll(whole, 0, m);
            }
            push(0, 0, m, 0, in.held, 0, key, taking, gt, ht, 0, 0, 0, 0, 0, whole);
            while (top > 0) {
                top--;
                if (stack[top * FIELDS] == 0) node();
                else split();
            }
        }

        void push(long kind, long a, long b, long va, long vb, long depth, long key, long some, long gt, long ht, long id, long j, long bin, long gl, long hl, long[] whole) {
            if ((top + 1) * FIELDS > stack.length) {
                stack = java.util.Arrays.copyOf(stack, 2 * stack.length);
                wholes = (long[][]) java.util.Arrays.copyOf(wholes, 2 * wholes.length);
            }
            int s = top * FIELDS;
            stack[s] = kind;
            stack[s + 1] = a;
            stack[s + 2] = b;
            stack[s + 3] = va;
            stack[s + 4] = vb;
            stack[s + 5] = depth;
            stack[s + 6] = key;
            stack[s + 7] = some;
            stack[s + 8] = gt;
            stack[s + 9] = ht;
            stack[s + 10] = id;
            stack[s + 11] = j;
            stack[s + 12] = bin;
            stack[s + 13] = gl;
            stack[s + 14] = hl;
            wholes[top] = whole;
            top++;
        }

        void added(int more) {
            if (nodes + more > child.length) {
                int room = Math.max(1024, 2 * (nodes + more));
                feature = java.util.Arrays.copyOf(feature, room);
                cut = java.util.Arrays.copyOf(cut, room);
                child = java.util.Arrays.copyOf(child, room);
                value = java.util.Arrays.copyOf(value, room);
            }
            for (int i = nodes; i < nodes + more; i++) {
                feature[i] = 0;
                cut[i] = 0;
                child[i] = -1;
                value[i] = 0;
            }
            nodes += more;
        }

        void sumAll(long[] to, int a, int b) {
            for (int j = 0; j < p; j++) sum(to, 2 * in.first[j], j, a, b);
        }

        void sum(long[] to, int at, int j, int a, int b) {
            int word = 1 + ((j + 1) >> 3), shift = ((j + 1) & 7) << 3;
            for (int o = a * words; o < b * words; o += words) {
                int c = at + (((int) (rows[o + word] >>> shift) & 255) << 1);
                to[c] += rows[o];
                to[c + 1] += rows[o + 1] & 255L;
            }
        }

        void sumTwo(long[] to, int at, int j, int at2, int j2, int a, int b) {
            int word = 1 + ((j + 1) >> 3), shift = ((j + 1) & 7) << 3, word2 = 1 + ((j2 + 1) >> 3), shift2 = ((j2 + 1) & 7) << 3;
            for (int o = a * words; o < b * words; o += words) {
                long g = rows[o], w = rows[o + 1] & 255L;
                int c = at + (((int) (rows[o + word] >>> shift) & 255) << 1), d = at2 + (((int) (rows[o + word2] >>> shift2) & 255) << 1);
                to[c] += g;
                to[c + 1] += w;
                to[d] += g;
                to[d + 1] += w;
            }
        }

        /** The features of the smallest hashes, ascending. */
        int choose(long key) {
            if (width >= p) {
                for (int j = 0; j < p; j++) chosen[j] = j;
                return p;
            }
            int n = 0;
            for (int j = 0; j < p; j++) {
                long x = mix(key ^ hashes[j]) ^ Long.MIN_VALUE;
                if (n == width && x > draw[n - 1]) continue;
                int k = n < width ? n++ : n - 1;
                while (k > 0 && draw[k - 1] > x) {
                    draw[k] = draw[k - 1];
                    by[k] = by[k - 1];
                    k--;
                }
                draw[k] = x;
                by[k] = j;
            }
            for (int i = 0; i < n; i++) {
                int k = i;
                while (k > 0 && chosen[k - 1] > by[i]) {
                    chosen[k] = chosen[k - 1];
                    k--;
                }
                chosen[k] = by[i];
            }
            return n;
        }

        void node() {
            int s = top * FIELDS;
            int a = (int) stack[s + 1], b = (int) stack[s + 2], va = (int) stack[s + 3], vb = (int) stack[s + 4], id = (int) stack[s + 10];
            long depth = stack[s + 5], key = stack[s + 6], some = stack[s + 7], gt = stack[s + 8], ht = stack[s + 9];
            long[] whole = wholes[top];
            wholes[top] = null;
            long open = 0;
            int from = least.length, to = -1;
            for (int d = 0; d < fits; d++) {
                if ((some >>> d & 1) != 0 && depth < limit[d] && (depth == 0 || ht >= 2 * least[which[d]])) {
                    open |= 1L << d;
                    from = Math.min(from, which[d]);
                    to = Math.max(to, which[d]);
                }
            }
            if (open != 0 && b > a) {
                int n = choose(key);
                best.begin(gt, ht, from, to);
                if (whole != null) {
                    for (int k = 0; k < n; k++) best.scan(whole, 2 * in.first[chosen[k]], in.count[chosen[k]], chosen[k], false);
                } else if (b - a < FEW) {
                    for (int k = 0; k < n; k++) few(a, b, chosen[k]);
                } else {
                    for (int k = 0; k < n; k += 2) {
                        if (k + 1 < n) sumTwo(scratch, 0, chosen[k], 512, chosen[k + 1], a, b);
                        else sum(scratch, 0, chosen[k], a, b);
                        for (int i = k; i < Math.min(n, k + 2); i++) best.scan(scratch, (i - k) << 9, in.count[chosen[i]], chosen[i], true);
                    }
                }
                for (int d = 0; d < fits; d++) {
                    if ((open >>> d & 1) != 0 && !(best.gain[which[d]] > 0)) open &= ~(1L << d);
                }
            } else {
                open = 0;
            }
            long closed = some & ~open;
            double mean = gt * unit / most(ht);
            if (emit) value[id] = mean;
            else if (closed != 0) {
                for (int d = 0; d < fits; d++) {
                    if ((closed >>> d & 1) != 0) {
                        double[] x = total[d];
                        for (int o = va * heldWords; o < vb * heldWords; o += heldWords) x[(int) held[o]] += mean;
                    }
                }
            }
            // Fits of the same cut go on together; the rows are dealt anew for each cut.
            while (open != 0) {
                int c = which[Long.numberOfTrailingZeros(open)];
                long same = 0;
                for (int d = 0; d < fits; d++) {
                    if ((open >>> d & 1) != 0 && best.feature[which[d]] == best.feature[c] && best.bin[which[d]] == best.bin[c]) same |= 1L << d;
                }
                open &= ~same;
                push(1, a, b, va, vb, depth, key, same, gt, ht, id, best.feature[c], best.bin[c], best.g[c], best.h[c], whole);
            }
        }

        /** A node of few rows: only the bins that they have are looked at. */
        void few(int a, int b, int j) {
            int word = 1 + ((j + 1) >> 3), shift = ((j + 1) & 7) << 3;
            long there0 = 0, there1 = 0, there2 = 0, there3 = 0;
            for (int o = a * words; o < b * words; o += words) {
                int bin = (int) (rows[o + word] >>> shift) & 255;
                scratch[2 * bin] += rows[o];
                scratch[2 * bin + 1] += rows[o + 1] & 255L;
                long bit = 1L << bin;
                switch (bin >> 6) {
                    case 0: there0 |= bit; break;
                    case 1: there1 |= bit; break;
                    case 2: there2 |= bit; break;
                    default: there3 |= bit;
                }
            }
            long gl = 0, hl = 0;
            for (int q = 0; q < 4; q++) {
                long there = q == 0 ? there0 : q == 1 ? there1 : q == 2 ? there2 : there3;
                while (there != 0) {
                    int bin = (q << 6) + Long.numberOfTrailingZeros(there);
                    there &= there - 1;
                    gl += scratch[2 * bin];
                    hl += scratch[2 * bin + 1];
                    scratch[2 * bin] = 0;
                    scratch[2 * bin + 1] = 0;
                    best.weigh(gl, hl, j, bin);
                }
            }
        }

        void split() {
            int s = top * FIELDS;
            int a = (int) stack[s + 1], b = (int) stack[s + 2], va = (int) stack[s + 3], vb = (int) stack[s + 4], id = (int) stack[s + 10], j = (int) stack[s + 11], bin = (int) stack[s + 12];
            long depth = stack[s + 5], key = stack[s + 6], some = stack[s + 7], gt = stack[s + 8], ht = stack[s + 9], gl = stack[s + 13], hl = stack[s + 14];
            long[] whole = wholes[top];
            wholes[top] = null;
            int m = part(rows, words, a, b, 1 + ((j + 1) >> 3), ((j + 1) & 7) << 3, bin);
            int vm = vb > va ? part(held, heldWords, va, vb, (j + 4) >> 3, ((j + 4) & 7) << 3, bin) : va;
            int left = 0, right = 0;
            if (emit) {
                left = nodes;
                right = nodes + 1;
                added(2);
                feature[id] = (short) j;
                cut[id] = (byte) bin;
                child[id] = left;
            }
            long[] ofLeft = null, ofRight = null;
            int small = Math.min(m - a, b - m);
            if (whole != null && b - a - small >= cells) {
                long[] one = new long[2 * cells], other = new long[2 * cells];
                boolean leftSmall = m - a == small;
                sumAll(one, leftSmall ? a : m, leftSmall ? m : b);
                for (int i = 0; i < other.length; i++) other[i] = whole[i] - one[i];
                if (small < cells) one = null;
                ofLeft = leftSmall ? one : other;
                ofRight = leftSmall ? other : one;
            }
            push(0, m, b, vm, vb, depth + 1, mix(key ^ 2), some, gt - gl, ht - hl, right, 0, 0, 0, 0, ofRight);
            push(0, a, m, va, vm, depth + 1, mix(key ^ 1), some, gl, hl, left, 0, 0, 0, 0, ofLeft);
        }

        /** Rows a to b, those up to the cut first; where the others begin. */
        int part(long[] x, int size, int a, int b, int word, int shift, int bin) {
            int l = a * size, r = 0;
            if (size == 3) {
                for (int o = a * 3; o < b * 3; o += 3) {
                    long v = x[o], v1 = x[o + 1], v2 = x[o + 2];
                    int right = (bin - ((int) (x[o + word] >>> shift) & 255)) >>> 31;
                    x[l] = v;
                    x[l + 1] = v1;
                    x[l + 2] = v2;
                    spare[r] = v;
                    spare[r + 1] = v1;
                    spare[r + 2] = v2;
                    r += right * 3;
                    l += 3 - right * 3;
                }
            } else if (size == 2) {
                for (int o = a * 2; o < b * 2; o += 2) {
                    long v = x[o], v1 = x[o + 1];
                    int right = (bin - ((int) (x[o + word] >>> shift) & 255)) >>> 31;
                    x[l] = v;
                    x[l + 1] = v1;
                    spare[r] = v;
                    spare[r + 1] = v1;
                    r += right * 2;
                    l += 2 - right * 2;
                }
            } else {
                for (int o = a * size; o < b * size; o += size) {
                    int right = (bin - ((int) (x[o + word] >>> shift) & 255)) >>> 31;
                    for (int k = 0; k < size; k++) {
                        long v = x[o + k];
                        x[l + k] = v;
                        spare[r + k] = v;
                    }
                    r += right * size;
                    l += size - right * size;
                }
            }
            System.arraycopy(spare, 0, x, l, r);
            return l / size;
        }
    }

    /** Level by level over all rows; of two children the smaller is summed, the other is their parent less it. */
    static class Boost {
        final Rows in;
        final int p, cells, leaves, limit;
        final boolean emit;
        final int[] stops;
        final double rate, start, least, l2, unit, leastGain;

        Boost(Rows in, ByteBuffer task) {
            this.in = in;
            p = in.p;
            cells = in.first[p];
            emit = task.getLong() != 0;
            leaves = (int) task.getLong();
            limit = (int) task.getLong();
            rate = task.getDouble();
            start = task.getDouble();
            least = task.getDouble();
            l2 = task.getDouble();
            unit = task.getDouble();
            leastGain = task.getDouble();
            stops = new int[(int) task.getLong()];
            for (int i = 0; i < stops.length; i++) stops[i] = (int) task.getLong();
        }

        byte[] run() {
            int n = in.n, rounds = stops[stops.length - 1], size = 2 * leaves;
            double[] score = new double[n], unseen = new double[in.held], value = new double[size], step = new double[size], gain = new double[size];
            java.util.Arrays.fill(score, start);
            java.util.Arrays.fill(unseen, start);
            long[] target = new long[n], g = new long[size], h = new long[size], cutG = new long[size], cutH = new long[size];
            long[] sums = new long[2 * leaves * cells], before = new long[2 * leaves * cells], packed = new long[cells];
            int[] feature = new int[size], bin = new int[size], child = new int[size], place = new int[size], by = new int[size], low = new int[size], high = new int[size];
            int[] order = new int[n], spare = new int[n];
            boolean[] open = new boolean[size];
            byte[][] columns = new byte[p][n];
            for (int j = 0; j < p; j++) {
                for (int i = 0; i < n; i++) columns[j][i] = in.bins[i * p + j];
            }
            Best best = new Best(new double[] {least}, leastGain, l2);
            ByteBuffer out = open(new byte[emit ? rounds * (8 + 15 * size) : 8 * stops.length * in.held]);
            int stop = 0;
            for (int r = 0; r < rounds; r++) {
                int end = 1, begin = 0, left = leaves - 1;
                g[0] = targets(target, score, order);
                h[0] = n;
                // Sums of targets and counts share a word for as many rows as fit into it.
                long largest = 1;
                for (int i = 0; i < n; i++) largest = Math.max(largest, Math.abs(target[i]));
                int some = largest < 1L << 40 ? (int) Math.min(65535, (1L << 46) / largest) : 0;
                java.util.Arrays.fill(sums, 0, 2 * cells, 0);
                sum(sums, 0, packed, target, order, 0, n, some);
                low[0] = 0;
                high[0] = n;
                place[0] = 0;
                open[0] = limit > 0;
                child[0] = -1;
                feature[0] = 0;
                bin[0] = 0;
                for (int depth = 0; begin < end; depth++) {
                    int cuts = 0;
                    for (int k = begin; k < end; k++) {
                        gain[k] = 0;
                        if (!open[k]) continue;
                        best.begin(g[k], h[k], 0, 0);
                        for (int j = 0; j < p; j++) best.scan(sums, 2 * (place[k] * cells + in.first[j]), in.count[j], j, false);
                        if (!(best.gain[0] > 0)) continue;
                        gain[k] = best.gain[0];
                        feature[k] = best.feature[0];
                        bin[k] = best.bin[0];
                        cutG[k] = best.g[0];
                        cutH[k] = best.h[0];
                        int i = cuts++;
                        while (i > 0 && gain[by[i - 1]] < gain[k]) {
                            by[i] = by[i - 1];
                            i--;
                        }
                        by[i] = k;
                    }
                    for (int i = left; i < cuts; i++) {
                        gain[by[i]] = 0;
                        feature[by[i]] = 0;
                        bin[by[i]] = 0;
                    }
                    left -= Math.min(cuts, left);
                    int next = end, room = 0;
                    long[] swap = before;
                    before = sums;
                    sums = swap;
                    for (int k = begin; k < end; k++) {
                        if (!(gain[k] > 0)) continue;
                        child[k] = next;
                        int middle = part(order, spare, columns[feature[k]], low[k], high[k], bin[k]);
                        low[next] = low[k];
                        high[next] = middle;
                        low[next + 1] = middle;
                        high[next + 1] = high[k];
                        g[next] = cutG[k];
                        h[next] = cutH[k];
                        g[next + 1] = g[k] - cutG[k];
                        h[next + 1] = h[k] - cutH[k];
                        for (int x = next; x < next + 2; x++) {
                            child[x] = -1;
                            feature[x] = 0;
                            bin[x] = 0;
                            open[x] = depth + 1 < limit && h[x] >= 2 * least && left > 0;
                        }
                        if (open[next] || open[next + 1]) {
                            int small = h[next + 1] < h[next] ? next + 1 : next, large = small == next ? next + 1 : next;
                            int x = 2 * room * cells, o = x + 2 * cells, w = 2 * place[k] * cells;
                            place[small] = room++;
                            place[large] = room++;
                            java.util.Arrays.fill(sums, x, o, 0);
                            sum(sums, x, packed, target, order, low[small], high[small], some);
                            for (int i = 0; i < 2 * cells; i++) sums[o + i] = before[w + i] - sums[x + i];
                        }
                        next += 2;
                    }
                    begin = end;
                    end = next;
                }
                for (int k = 0; k < end; k++) {
                    value[k] = g[k] * unit / most(h[k] + l2);
                    step[k] = rate * value[k];
                    if (child[k] < 0) add(score, order, low[k], high[k], step[k]);
                }
                for (int i = 0; i < in.held; i++) {
                    int k = 0, o = i * p;
                    while (child[k] >= 0) k = child[k] + ((bin[k] - (in.heldBins[o + feature[k]] & 255)) >>> 31);
                    unseen[i] += step[k];
                }
                if (emit) {
                    out.putLong(end);
                    for (int k = 0; k < end; k++) out.putDouble(value[k]);
                    for (int k = 0; k < end; k++) out.putInt(child[k]);
                    for (int k = 0; k < end; k++) out.putShort((short) feature[k]);
                    for (int k = 0; k < end; k++) out.put((byte) bin[k]);
                }
                while (stop < stops.length && stops[stop] == r + 1) {
                    for (int i = 0; i < in.held && !emit; i++) out.putDouble(in.heldY[i] - unseen[i]);
                    stop++;
                }
            }
            return java.util.Arrays.copyOf(out.array(), out.position());
        }

        long targets(long[] target, double[] score, int[] order) {
            long gt = 0;
            for (int i = 0; i < target.length; i++) {
                long x = (long) Math.rint((in.y[i] - score[i]) / unit);
                target[i] = x;
                gt += x;
                order[i] = i;
            }
            return gt;
        }

        static void add(double[] score, int[] order, int from, int to, double step) {
            for (int i = from; i < to; i++) score[order[i]] += step;
        }

        static int part(int[] order, int[] spare, byte[] column, int from, int to, int bin) {
            int l = from, r = 0;
            for (int i = from; i < to; i++) {
                int x = order[i], right = (bin - (column[x] & 255)) >>> 31;
                order[l] = x;
                spare[r] = x;
                r += right;
                l += 1 - right;
            }
            System.arraycopy(spare, 0, order, l, r);
            return l;
        }

        /** Adds the rows to the sums (g, h) from ``at`` on. */
        void sum(long[] sums, int at, long[] packed, long[] target, int[] order, int from, int to, int some) {
            if (some == 0) {
                for (int i = from; i < to; i++) {
                    for (int j = 0; j < p; j++) {
                        int c = at + (in.first[j] + (in.bins[order[i] * p + j] & 255) << 1);
                        sums[c] += target[order[i]];
                        sums[c + 1]++;
                    }
                }
                return;
            }
            for (int i = from; i < to; i += some) {
                sumPacked(packed, in.bins, in.first, target, order, i, Math.min(to, i + some));
                for (int c = 0; c < cells; c++) {
                    long x = packed[c];
                    sums[at + 2 * c] += x >> 16;
                    sums[at + 2 * c + 1] += x & 65535;
                    packed[c] = 0;
                }
            }
        }

        void sumPacked(long[] packed, byte[] bins, int[] first, long[] target, int[] order, int from, int to) {
            for (int i = from; i < to; i++) {
                int row = order[i], o = row * p;
                long x = (target[row] << 16) + 1;
                for (int j = 0; j < p; j++) packed[first[j] + (bins[o + j] & 255)] += x;
            }
        }
    }

    /** A model: cut points, bins of the medians, and the nodes of all trees; a leaf is its own child. */
    static class Model {
        final double base, rate;
        final boolean mean;
        final int trees;
        final double[][] edges;
        final int[] fill;
        final long[] steps;
        final double[] value;

        Model(ByteBuffer in) {
            base = in.getDouble();
            rate = in.getDouble();
            mean = in.getLong() != 0;
            trees = (int) in.getLong();
            int p = (int) in.getLong();
            fill = new int[p];
            edges = new double[p][];
            for (int j = 0; j < p; j++) {
                fill[j] = (int) in.getLong();
                edges[j] = new double[(int) in.getLong()];
                for (int i = 0; i < edges[j].length; i++) edges[j][i] = in.getDouble();
            }
            steps = new long[(int) in.getLong()];
            for (int i = 0; i < steps.length; i++) steps[i] = in.getLong();
            value = new double[(int) in.getLong()];
            for (int i = 0; i < value.length; i++) value[i] = in.getDouble();
        }

        /** Four trees are walked side by side; the roots are the first nodes. */
        double score(int[] bins) {
            double out = 0;
            int t = 0;
            for (; t + 4 <= trees; t += 4) {
                int a = t, b = t + 1, c = t + 2, d = t + 3, moved;
                do {
                    int a2 = next(steps[a], bins), b2 = next(steps[b], bins), c2 = next(steps[c], bins), d2 = next(steps[d], bins);
                    moved = (a ^ a2) | (b ^ b2) | (c ^ c2) | (d ^ d2);
                    a = a2;
                    b = b2;
                    c = c2;
                    d = d2;
                } while (moved != 0);
                out = out + value[a] + value[b] + value[c] + value[d];
            }
            for (; t < trees; t++) {
                int a = t, a2;
                while ((a2 = next(steps[a], bins)) != a) a = a2;
                out += value[a];
            }
            return mean ? out / trees : base + rate * out;
        }

        static int next(long step, int[] bins) {
            return (int) (step >>> 32) + (((int) step & 255) - bins[(int) (step >>> 8) & 0xFFFFFF] >>> 31);
        }
    }

    /** The score of a row; rows of the same bins that follow soon are not walked again. */
    public static class Scores implements org.apache.spark.sql.api.java.UDF1, java.io.Serializable {
        private static final int KEPT = 4096;
        private static long heldId = -1;
        private static Model held;
        private final org.apache.spark.broadcast.Broadcast table;
        private transient Model model;
        private transient int[] bins;
        private transient int[][] keys;
        private transient double[] known;

        public Scores(org.apache.spark.broadcast.Broadcast table) {
            this.table = table;
        }

        private static synchronized Model of(org.apache.spark.broadcast.Broadcast table) {
            if (held == null || heldId != table.id()) {
                held = new Model(open((byte[]) table.value()));
                heldId = table.id();
            }
            return held;
        }

        public Object call(Object values) {
            if (model == null) {
                model = of(table);
                bins = new int[model.fill.length];
                keys = new int[KEPT][];
                known = new double[KEPT];
            }
            scala.collection.Iterator it = ((scala.collection.Seq) values).iterator();
            int hash = 17;
            for (int j = 0; j < bins.length; j++) {
                Object x = it.next();
                bins[j] = x == null || ((Double) x).isNaN() ? model.fill[j] : bin(model.edges[j], ((Double) x).doubleValue());
                hash = 31 * hash + bins[j];
            }
            hash = (hash ^ (hash >>> 15)) * 0x2C1B3C6D;
            int slot = (hash ^ (hash >>> 12)) & (KEPT - 1);
            if (keys[slot] == null || !java.util.Arrays.equals(keys[slot], bins)) {
                known[slot] = model.score(bins);
                keys[slot] = (int[]) bins.clone();
            }
            return Double.valueOf(known[slot]);
        }

        /** How many cut points are below a value. */
        static int bin(double[] edges, double x) {
            int low = 0, high = edges.length;
            while (low < high) {
                int mid = (low + high) >>> 1;
                if (edges[mid] < x) low = mid + 1;
                else high = mid;
            }
            return low;
        }
    }
}
"""


_CLASSES: dict = {}
_MAKING = threading.Lock()


def _class(spark: SparkSession):
    """The class, compiled and shipped to the executors once an application."""
    sc = spark.sparkContext
    with _MAKING:
        if sc.applicationId not in _CLASSES:
            compiler = sc._jvm.org.codehaus.janino.SimpleCompiler()
            compiler.cook(SOURCE)
            made = compiler.getBytecodes()
            folder = tempfile.TemporaryDirectory(prefix="panelwright-kernels-")  # executors fetch the jar from here as long as the application runs
            path = os.path.join(os.path.realpath(folder.name), "kernels.jar")
            with zipfile.ZipFile(path, "w") as jar:
                for name in made.keySet():
                    jar.writestr(f"{name.replace('.', '/')}.class", bytes(made.get(name)))
            spark._jsparkSession.sessionState().resourceLoader().addJar(path)
            _CLASSES[sc.applicationId] = spark._jsparkSession.sharedState().jarClassLoader().loadClass(NAME), folder
        return _CLASSES[sc.applicationId][0]


def words(*values) -> bytes:
    """Whole numbers, other numbers and arrays of them as little-endian words; an array has its length before it."""
    out = []
    for x in values:
        x = np.asarray(x)
        x = x.astype("<f8") if x.dtype.kind == "f" else x.astype("<u8" if x.dtype.kind == "u" else "<i8")
        out.append((np.int64(len(x)).tobytes() if x.ndim else b"") + x.tobytes())
    return b"".join(out)


def table_bytes(row, fold, y, bins) -> bytes:
    """The table as the tasks read it."""
    return b"".join([words(len(row), bins.shape[1]), *(np.ascontiguousarray(x).astype(t).tobytes() for x, t in ((row, "<i8"), (y, "<f8"), (fold, "<i4"), (bins, "u1")))])


def model_bytes(model) -> bytes:
    """A :class:`panelwright.operators.trees.TreeModel` as the scores read it: all roots, then all other nodes."""
    n = sum(t[0] for t in model.trees)
    steps, values, root, at = [], [], 0, n
    rest, rest_values = [], []
    for roots, feature, cut, child, value in model.trees:
        # Of a group, the roots stand first: their places go up by those of earlier groups, the others' by all roots.
        place = np.concatenate([np.arange(root, root + roots), np.arange(at, at + len(child) - roots)])
        leaf = child < 0
        to = np.where(leaf, place, place[np.maximum(child, 0)])
        step = to << 32 | np.where(leaf, 0, feature).astype(np.int64) << 8 | np.where(leaf, 255, cut)
        steps.append(step[:roots])
        values.append(value[:roots])
        rest.append(step[roots:])
        rest_values.append(value[roots:])
        root, at = root + roots, at + len(child) - roots
    features = [words(int(f), np.asarray(e, dtype=float)) for f, e in zip(model.fill, model.edges, strict=True)]
    return b"".join([words(float(model.base), float(model.rate), model.kind != "boost", n, len(features)), *features, words(np.concatenate(steps + rest), np.concatenate(values + rest_values))])


def send(spark: SparkSession, made: bytes):
    """A table or a model, broadcast to the executors' JVMs; None where the session has no JVM at hand or the class cannot be made there."""
    try:
        _class(spark)
        return spark.sparkContext._jsc.broadcast(made)
    except (AttributeError, Py4JError, PySparkException) as gone:
        warnings.warn(f"trees are grown and walked by NumPy: {str(gone)[:500]}", stacklevel=2)
        return None


def _called(spark: SparkSession, name: str, *args) -> Column:
    """A static method of the class that gives a column."""
    method = next(m for m in _class(spark).getMethods() if m.getName() == name)
    held = spark.sparkContext._gateway.new_array(spark.sparkContext._jvm.java.lang.Object, len(args))
    for i, x in enumerate(args):
        held[i] = x
    return Column(method.invoke(None, held))


def run_tasks(spark: SparkSession, table, tasks: list[bytes]) -> DataFrame:
    """``(id, found)`` of every task, each a partition of its own, in their order."""
    start = np.cumsum([1 + len(tasks), *[len(t) // 8 for t in tasks]])[:-1]
    rows = spark.range(0, len(tasks), 1, len(tasks))
    return rows.select("id", _called(spark, "of", table, words(len(tasks)) + start.astype("<i8").tobytes() + b"".join(tasks), rows["id"]._jc).alias("found"))


def scores(spark: SparkSession, model, values: Column) -> Column:
    """The score of each row from the array of its values (doubles; null or NaN: missing)."""
    return _called(spark, "scores", model, values._jc)


__all__ = ["model_bytes", "run_tasks", "scores", "send", "table_bytes", "words"]
